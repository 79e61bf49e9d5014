import base64
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import language_id, quality, queries

SF_DIR = "/root/testdata/sf0.01"


def test_statistics_of_odd_texts():
    assert quality.statistics(None) == quality.statistics("") == [0.0] * len(quality.STATS)
    for text in (" ", "\n", "A", "é", "x" * 100_000, "日本"):
        assert len(quality.statistics(text)) == len(quality.STATS) and np.isfinite(quality.statistics(text)).all()
    assert dict(zip(quality.STATS, quality.statistics("AB cd")))["upper"] == 0.4


@pytest.mark.parametrize("seed", range(5))
def test_pooled_is_the_best_monotone_curve(seed):
    draw = np.random.default_rng(seed)
    count = draw.integers(1, 5, 12).astype(float)
    positive = np.array([draw.integers(0, n + 1) for n in count]).astype(float)
    got = quality.pooled(positive, count)
    # minimax form of isotonic regression
    want = [max(min(positive[a:b + 1].sum() / count[a:b + 1].sum() for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
    assert np.allclose(got, want) and (np.diff(got) >= 0).all()


def test_fit_solves_the_ridge_problem(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(300, len(quality.STATS)))
    y = (x[:, 0] + x[:, 3] ** 2 > 0.8).astype(int)
    rows = [(a.tolist(), int(b)) for a, b in zip(x, y)] + [(None, 1), (x[0].tolist(), None), (x[0].tolist(), 5)]
    df = spark.createDataFrame(rows, "stats array<double>, label int").repartition(5)
    model = quality.fit(df, features=40)
    z = model.features(x)
    penalty = np.eye(41) * 1e-3 * 300
    penalty[-1, -1] = 0
    want = np.linalg.solve(z.T @ z + penalty + 1e-9 * np.eye(41), z.T @ y)
    assert np.allclose(model.weights, want)
    assert quality.fit(df.limit(0)) is None
    one = quality.fit(df.filter("label = 1"), features=10)
    assert np.allclose(one.score(x[:3]), 1)


def test_quality_cases(spark, documents):
    docs = documents([(1, "Good words here."), (2, "BAD!! BAD!!"), (3, None), (4, ""), (None, "x"), (1, "Good words here.")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (9, 1), (None, 1), (3, None)], "doc_id bigint, quality int")
    scored, model = quality.classify(docs, labels, F.lit(True))
    got = [(r.doc_id, r.score) for r in scored.collect()]
    assert len(got) == 6 and model is not None and all(0 <= s <= 1 for _, s in got)
    assert {s for i, s in got if i == 1} == {max(s for _, s in got)}
    empty, none = quality.classify(docs, labels.limit(0), F.lit(True))
    assert none is None and {r.score for r in empty.collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels, F.lit(True))[0].collect() == []


def test_quality_query_on_held_out_rows(spark):
    got = queries.quality_scores(spark, SF_DIR).toPandas()
    assert len(got) == 1000 and list(got.columns[:4]) == ["doc_id", "held_out", "score", "predicted"]
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(got.doc_id, got.held_out))
    labels = queries.read(spark, SF_DIR, "labels").toPandas()
    both = got[got.held_out].merge(labels, on="doc_id")
    assert len(both) > 50 and (both.predicted == both.quality).mean() > 0.95


def test_language_cases(documents):
    rows = [(i, f"the with and that number {i}", "en") for i in range(20)]
    rows += [(100 + i, f"der und nicht schlag nummer {i}", "de") for i in range(20)]
    rows += [(200, None, "en"), (201, "", "de"), (202, "123 !!", "en"), (203, "the and", None), (None, "und der", "de"),
             (1, "the with and that number 1", "en"), (204, "日本語テキスト", None), (205, "w" * 100_000, None)]
    docs = documents(rows)
    model = language_id.fit(docs, F.col("doc_id") < 110)
    got = {(r.doc_id, r.lang_pred, r.rejected, r.score) for r in language_id.predict(docs, model).collect()}
    by = {i: (lang, gone, score) for i, lang, gone, score in got}
    assert by[200] == by[201] == by[202] == ("und", True, 0.0)
    assert by[203][:2] == ("en", False) and by[None][:2] == ("de", False) and by[115][0] == "de"
    assert by[204][1] and by[204][0] in ("en", "de")
    assert all(0 <= s <= 1 for *_, s in got)
    assert language_id.predict(docs, model).count() == len(rows)
    assert language_id.fit(docs, F.col("doc_id") < 0) is None
    none = {r.doc_id: (r.lang_pred, r.rejected) for r in language_id.predict(docs, None).collect()}
    assert none[1] == ("und", False) and none[202] == ("und", True)
    assert language_id.predict(docs.limit(0), model).collect() == []


def test_language_query_on_held_out_rows(spark):
    got = queries.languages(spark, SF_DIR).toPandas()
    docs = queries.read(spark, SF_DIR, "documents").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out))
    both = got[got.held_out].merge(docs, on="doc_id")
    assert (both.lang_pred == both.lang).mean() > 0.97 and got.rejected.mean() < 0.005


POLISH = """Wczoraj wieczorem poszliśmy do teatru, ponieważ nasi przyjaciele dostali bilety na nową sztukę. Było bardzo
ciekawie i wszyscy śmiali się głośno. Potem wróciliśmy do domu pieszo, bo noc była ciepła, a ulice puste i ciche."""
RUSSIAN = "Сегодня хорошая погода, и мы пошли гулять в парк, где играли дети и пели птицы."
JAPANESE = "日本語の文章は漢字とひらがなとカタカナで書かれます。今日は天気が良いので散歩に行きました。" * 6
JUNK = {
    1: POLISH, 2: "Dziękuję bardzo za wszystko", 3: RUSSIAN, 4: RUSSIAN * 20, 5: JAPANESE,
    6: base64.b64encode(np.random.default_rng(1).bytes(900)).decode(),
    7: " ".join("".join(w) for w in np.random.default_rng(2).choice(list("abcdefghijklmnopqrstuvwxyz"), (150, 6))),
}


def test_unlearned_languages_and_junk_are_rejected(spark):
    docs = queries.read(spark, SF_DIR, "documents").select("doc_id", "text", "lang")
    whole = docs.filter("lang is not null and length(text) > 200").limit(200).collect()
    planted = spark.createDataFrame([(-i, t, None) for i, t in JUNK.items()], docs.schema)
    shorts = [(-100 - n, r.text[: r.text.rfind(" ", 0, 90)], r.lang) for n, r in enumerate(whole) if " " in r.text[:90]]
    # odd rows with a label do not open the door for their like
    odd = spark.createDataFrame([(-1000, JUNK[6] + "x", "en"), (-1001, JAPANESE + JAPANESE[:40], "de"), (-1002, "zq", "fr")], docs.schema)
    model = language_id.fit(docs.union(odd), F.lit(True))
    got = {r.doc_id: r for r in language_id.predict(docs.union(planted).union(spark.createDataFrame(shorts, docs.schema)), model).collect()}
    assert [i for i in JUNK if not got[-i].rejected] == []
    assert sum(got[i].rejected for i, *_ in shorts) <= 0.03 * len(shorts)
    assert sum(r.rejected for i, r in got.items() if i >= 0) <= 5


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_quality_query_by_brute_force(spark):
    """Every score of the query from plain matrices over all labelled rows at once."""
    docs = queries.read(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    labels = {r.doc_id: r.quality for r in queries.read(spark, SF_DIR, "labels").collect() if r.quality in (0, 1)}
    stats = {r.doc_id: np.array(quality.statistics(r.text)) for r in docs}
    learned = [i for i in stats if i in labels and crc(i) % 4 != 2]
    x, y = np.array([stats[i] for i in learned]), np.array([labels[i] for i in learned], float)
    mean, deviation = x.mean(0), x.std(0)
    draw = np.random.default_rng(11)
    directions, phases = draw.normal(0, 1 / 4.0, (x.shape[1], 256)), draw.uniform(0, 2 * np.pi, 256)

    def features(rows):
        z = np.clip((rows - mean) / np.where(deviation > 1e-9, deviation, 1.0), -5, 5)
        return np.hstack([np.sqrt(2 / 256) * np.cos(z @ directions + phases), np.ones((len(z), 1))])

    penalty = np.eye(257) * 1e-3 * len(x)
    penalty[-1, -1] = 0
    z = features(x)
    weights = np.linalg.solve(z.T @ z + penalty + 1e-9 * np.eye(257), z.T @ y)
    at = np.clip(((z @ weights + 0.5) / 2.0 * quality.BINS).astype(int), 0, quality.BINS - 1)
    bins = sorted(set(at))
    curve = quality.pooled(np.array([y[at == b].sum() for b in bins]), np.array([(at == b).sum() for b in bins], float))
    centres = [-0.5 + (b + 0.5) * 2.0 / quality.BINS for b in bins]
    want = {i: float(np.clip(np.interp(features(s[None]) @ weights, centres, curve), 0, 1)[0]) for i, s in stats.items()}
    got = {r.doc_id: r for r in queries.quality_scores(spark, SF_DIR).collect()}
    assert got.keys() == want.keys()
    # a raw score on the border of two bins may fall to either side of it, which moves the curve a little
    off = [abs(got[i].score - want[i]) for i in want]
    assert np.median(off) < 1e-6 and np.quantile(off, 0.99) < 0.02
    assert all(r.held_out == (crc(i) % 4 == 2) and r.predicted == int(r.score >= 0.7) for i, r in got.items())


def plain_grams(text):
    """The hashed 2- and 3-byte grams of a text, from slices of its bytes."""
    keep = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))
    raw = b" " + text.lower().encode("utf-8", "replace").translate(keep) + b" "
    out = {}
    for k, salt in ((2, 0x9E3779B1), (3, 0x85EBCA77)):
        for i in range(len(raw) - k + 1):
            gram = raw[i : i + k]
            if k == 2 and gram == b"  " or k == 3 and b"  " in gram:
                continue
            code = gram[0] * 257 + gram[1] if k == 2 else (gram[0] * 257 + gram[1]) * 263 + gram[2]
            place = (code * salt & 0xFFFFFFFF) >> 20
            out[place] = out.get(place, 0) + 1
    return out


def test_language_query_by_brute_force(spark):
    """Document frequencies over all training rows, and every prediction, from plain dictionaries of grams."""
    docs = queries.read(spark, SF_DIR, "documents").withColumn("held_out", queries.id_remainder("doc_id", 3) == 1)
    model = language_id.fit(docs, ~F.col("held_out"))
    rows = docs.collect()
    frequency, seen = np.zeros(language_id.DIMS), 0
    for r in rows:
        if not r.held_out and r.text is not None and r.lang is not None:
            frequency[list(plain_grams(r.text))] += 1
            seen += 1
    idf = np.log((1 + seen) / (1 + frequency)) + 0.1
    assert np.allclose(model.idf, idf, rtol=1e-5)
    got = {r.doc_id: r for r in queries.languages(spark, SF_DIR).collect()}
    assert got.keys() == {r.doc_id for r in rows}
    for r in rows:
        found = got[r.doc_id]
        assert found.held_out == (crc(r.doc_id) % 3 == 1)
        if not r.text or not any(map(str.isalpha, r.text)):
            assert (found.lang_pred, found.score) == ("und", 0)
            continue
        weights = {place: (1 + np.log(n)) * idf[place] for place, n in plain_grams(r.text).items()}
        norm = np.sqrt(sum(w * w for w in weights.values()))
        cosines = model.centroids[:, list(weights)] @ np.array(list(weights.values())) / norm
        assert found.score == pytest.approx(min(max(float(cosines.max()), 0), 1), abs=1e-4)
        best = {model.languages[c] for c in np.flatnonzero(cosines > cosines.max() - 1e-4)}
        assert found.lang_pred in best
