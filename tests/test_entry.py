"""The optional queries fall away when something they need is missing."""

import subprocess
import sys


def test_core_queries_without_the_optional_parts():
    code = ("import sys; sys.modules['public_tokenizers'] = None\n"
            "import __spark_entry__ as e\n"
            "assert 'topic_terms' in e.queries() and 'topic_terms' in e.oracle_sql()\n"
            "assert not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
