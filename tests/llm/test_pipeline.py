import corpus_pipeline as C
from test_jaccard_join import plain_set

from tidewell.llm import decontamination as D, piece_codec, queries

SF_DIR = "/root/testdata/sf0.01"


def test_stages_over_documents(spark):
    docs = queries.read(spark, SF_DIR, "documents")
    labels = {r.doc_id: r.quality for r in queries.read(spark, SF_DIR, "labels").collect()}
    items = [D.normal(r.text) for r in queries.read(spark, SF_DIR, "benchmark").collect()]
    seen = [docs]
    for name, stage in C.STAGES:
        out = C.staged(stage(spark, seen[-1], SF_DIR), name)
        if name != C.STAGES[-1][0]:
            assert out.columns == docs.columns and out.schema == docs.schema
        seen.append(out)
    rows = [{r.doc_id: r for r in s.collect()} for s in seen]
    raw, good, known, single, clean, coded = rows
    gone = lambda a, b: a.keys() - b.keys()
    judged = [labels[i] for i in gone(raw, good) if i in labels]
    assert judged and sum(judged) <= 0.1 * len(judged)
    kept = [labels[i] for i in good if i in labels]
    assert sum(kept) >= 0.97 * len(kept)
    assert len(gone(good, known)) <= 0.005 * len(good)
    # of each group of near copies the smallest id stays, and nothing else goes
    sets = {i: plain_set(r.text) for i, r in known.items()}
    leader = {i: i for i in sets}

    def top(i):
        while leader[i] != i:
            i = leader[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                leader[max(top(a), top(b))] = min(top(a), top(b))
    assert single.keys() == {i for i in sets if top(i) == i} and len(single) < len(known)
    ids = sorted(single)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                assert 100 * len(sets[a] & sets[b]) < 75 * len(sets[a] | sets[b])
    holds = lambda r: any(t in D.normal(r.text) for t in items)
    assert not any(map(holds, clean.values())) and any(map(holds, single.values()))
    assert len(gone(single, clean)) <= 1.2 * sum(map(holds, single.values()))
    assert coded.keys() == clean.keys()
    assert all(r.decoded == clean[i].text.replace(piece_codec.MARK, " ") and r.n_tokens == len(r.ids) for i, r in coded.items())
    assert sorted(r.doc_id for r in C.run(spark, SF_DIR).collect()) == sorted(coded)


def test_stages_on_odd_rows(spark, tmp_path):
    item = "Where did the tall grey heron stand in the morning?"
    rows = [(1, "The plain words of a text that is good."), (2, None), (3, ""), (4, "123 456"), (5, "The plain words of a text that is good."),
            (6, f"So: {item}"), (None, "Some words"), (7, "long words here " * 20_000), (7, "long words here " * 20_000), (8, "The plain words of another text.")]
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, rejected string, hits string, label string"
    whole = [(i, t, "en", None, None, 1, "x", "y", "z") for i, t in rows]
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, table in (("some", whole), ("none", [])):
        docs = spark.createDataFrame(table, ddl)
        left = []
        for _, stage in C.STAGES:
            docs = C.staged(stage(spark, docs, str(tmp_path)), "odd")
            left.append(sorted((r[0] for r in docs.collect()), key=repr))
        if name == "none":
            assert left == [[]] * 5
        else:
            assert left[0] == sorted((i for i, _ in rows), key=repr)
            assert left[1] == [1, 5, 6, 7, 7, 8, None] and left[2] == [1, 6, 7, 8, None] and left[3] == left[4] == [1, 7, 8, None]
