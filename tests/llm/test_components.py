"""Connected components: brute force, and rounds only while they are needed."""

import random

import pytest

from topicforge.llm import components


def brute(links):
    label = {n: n for pair in links if None not in pair for n in pair}
    for u, v in [p for p in links if None not in p]:
        a, b = sorted((label[u], label[v]))
        label = {n: a if x == b else x for n, x in label.items()}
    return label


@pytest.fixture
def written(monkeypatch):
    labels, write = [], components.scratch_table
    monkeypatch.setattr(components, "scratch_table", lambda df, label: labels.append(label) or write(df, label))
    return labels


def found(spark, links):
    rows = components.connected(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}


def test_stars_take_no_round(spark, written):
    links = [(100 + i, 7) for i in range(50)] + [(3, 200), (3, 3), (9, 9), (None, 4), (4, None), (200, 3), (200, 3)]
    assert found(spark, links) == brute(links)
    assert written == ["edges"]


def test_first_stars_end_the_rounds(spark, written):
    links = [(i + 1, i) for i in range(3)]
    assert found(spark, links) == brute(links)
    assert len(written) <= 3


def test_any_graph(spark):
    r = random.Random(11)
    links = [(r.randrange(120), r.randrange(120)) for _ in range(70)] + [(1000 + i, 1001 + i) for i in range(20)]
    links += [(2000, 2000 + i) for i in range(30)] + [(3000 - i, 3000) for i in range(30)]
    assert found(spark, links) == brute(links)
    assert found(spark, [(None, 1)]) == {}
