"""What the third round's findings named in the join of near copies: texts sent and rows made in proportion to the input."""

import random

import numpy as np
from lumenframe.llm import jaccard


def test_texts_of_large_clusters_are_sent_few_times(spark, monkeypatch):
    """near copies that fill many units go to each unit of the same component no more; their odd neighbours still meet all of them."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**7)}" for _ in range(200)]
    rows = []
    for i in range(400):  # each near the base, and most near each other
        near = list(base)
        for at in rng.sample(range(200), 2):
            near[at] = f"v{rng.randrange(10**7)}"
        rows.append((i, " ".join(near)))
    rows += [(1000 + i, " ".join(base[:100] + [f"z{rng.randrange(10**7)}" for _ in range(100)])) for i in range(20)]
    sent = []
    own = jaccard.materialize

    def counted(df, name):
        out = own(df, name)
        if name == "units":
            sent.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "materialize", counted)
    monkeypatch.setattr(jaccard, "UNIT", 4000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in jaccard.components(docs, 5, 80, rare=True).collect()}
    assert found == {i: 0 if i < 1000 else i for i, _ in rows}
    assert sum(sent) < 10 * len(rows)


def test_link_rows_are_distinct(spark, monkeypatch):
    """The pipeline's check: two near copies that meet in many ranges of keys are one pair, and one row."""
    monkeypatch.setattr(jaccard, "LISTED", 1000)
    docs = spark.createDataFrame([(i, " ".join(f"{i // 2}w{k}" for k in range(100)) + (" end" if i % 2 else "")) for i in range(200)], "doc_id long, text string").repartition(8)
    made = []
    own = type(docs).distinct
    monkeypatch.setattr(type(docs), "distinct", lambda self: own(made.append(self.count()) or self))
    met = jaccard._candidates(docs, 20_000, 5, 80, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    assert sorted((r.a, r.b) for r in met.collect()) == [(2 * i, 2 * i + 1) for i in range(100)]
    assert made in ([], [100])
