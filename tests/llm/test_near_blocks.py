import numpy as np

from waymark.llm import near_dedup


def test_large_buckets_are_compared_in_blocks_without_losing_a_link(spark, monkeypatch):
    """Texts around one that none of them reaches, in blocks of three: pairs among them are found as in whole buckets."""
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    core, rows = [word() for _ in range(200)], []
    for i in range(24):
        own = list(core)
        for at in rng.choice(200, 10, replace=False):
            own[at] = word()
        rows.append((i, " ".join(own)))
        if i % 4 == 0:
            rows.append((100 + i, " ".join([*own[:-1], word()])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = lambda: sorted((r.doc_id, r.class_id) for r in near_dedup.near_duplicates(docs).collect())

    def plain():
        bags = {i: np.unique(near_dedup.Shingles().of(t), return_counts=True) for i, t in rows}
        top = {i: i for i in bags}
        find = lambda i: i if top[i] == i else find(top[i])
        for a in bags:
            for b in bags:
                if a < b and near_dedup.overlap(bags[a], bags[b]) >= 0.8:
                    x, y = sorted((find(a), find(b)))
                    top[y] = x
        return sorted((i, find(i)) for i in bags)

    want = plain()
    assert len({c for _, c in want}) > 20
    monkeypatch.setattr(near_dedup, "BUCKET_BLOCK", 3)
    assert classes() == want
