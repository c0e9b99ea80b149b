"""Connected components: right on any graph, and no more written rounds and exchanges than needed."""

import random

from corpusflow.llm import components


def expected(edges):
    least = {}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            least.setdefault(a, a), least.setdefault(b, b)
            x, y = sorted((root(a), root(b)))
            least[y] = x
    return {x: root(x) for x in least}


def table(spark, edges):
    return spark.createDataFrame(edges, "x long, y long")


def test_any_graph(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += edges[:30] + [(b, a) for a, b in edges[:30]] + [(7, 7), (None, 3), (4, None), (None, None)]
    for some in (edges, []):
        found = [tuple(r) for r in components.connected_components(table(spark, some)).collect()]
        assert len(found) == len(set(found)) and dict(found) == expected(some)


def test_steps_keep_components_and_labels_are_never_wrong(spark):
    edges = [(i + 1, i) for i in range(60)] + [(200, 100), (200, 101), (201, 101)]
    moved = components.joined(table(spark, edges))
    whole = expected(edges)
    assert expected([tuple(r) for r in moved.collect()]) == whole
    for node, component in components.least_neighbours(moved).collect():
        assert whole[node] == whole[component]


def test_stars_are_written_once_and_a_round_takes_four_exchanges(spark, monkeypatch):
    written = []
    kept = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, purpose: written.append(purpose) or kept(df, purpose))
    stars = [(i, i // 10 * 10) for i in range(100)]
    assert len(dict(components.connected_components(table(spark, stars)).collect())) == 100
    assert len(written) == 1
    # A leaf that two stars share: one round, and no further one to see that nothing moves.
    assert dict(components.connected_components(table(spark, [(5, 1), (5, 2), (6, 2)])).collect())[6] == 1
    assert len(written) <= 1 + 3
    edges = kept(table(spark, stars).where("x <> y").toDF("a", "b"), "edges")
    plan = components.star_step(edges.hint("merge"))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 1 and plan.count("Window [") == 1
    planned = components.star_step(edges)._jdf.queryExecution().executedPlan().toString()
    assert planned.count("Exchange hashpartitioning") <= 4
