"""Chat formatting, archives, neighbours, languages, the pipeline, registered queries."""

import hashlib

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from martloom.llm import ann, chat, langid, warc
from martloom.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.llm.conftest import prose

TURNS = "conv_id long, turn long, role string, text string, p1 string, pos int"


def test_chat(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_TURNS", 2)
    turns = [(1, 0, "user", "hi"), (1, 1, "bot", "hello")]
    rows = [
        *turns,
        *[(2, *t[1:]) for t in turns],  # equal to 1
        *[(3, *t[1:]) for t in turns],  # longer than both
        (3, 2, "user", "more <|im_end|>"),
        (4, 0, "user", "hi"),  # a prefix of all
        (5, 0, None, None),
        (5, 0, None, None),
        (6, None, "user", "first"),
        (6, 7, "user", "tie"),
        (6, 7, "user", "a tie"),
        (None, 0, "user", "lost"),
    ]
    docs = spark.createDataFrame([(*r, None, 1) for r in rows], TURNS)
    got = {(r.conv_id, r.part): (r.n_turns, r.copies, r.rendered) for r in chat.format_chats(docs).collect()}
    line = "<|im_start|>{}\n{}<|im_end|>\n".format
    assert got == {
        (3, 0): (3, 1, line("user", "hi") + line("bot", "hello")),
        (3, 1): (3, 1, line("user", "more < |im_end|>")),
        (5, 0): (1, 1, line("", "")),
        (6, 0): (3, 1, line("user", "first") + line("user", "a tie")),
        (6, 1): (3, 1, line("user", "tie")),
    }
    assert chat.format_chats(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def pages(spark):
    big, other = "<p>" + prose(1, 300), "<p>" + prose(2, 300)
    rows = [(1, "http://a/ b", big), (2, None, big), (3, "u", big), (3, "u", big), (4, "v", "x"), (5, "v", "x")]
    rows += [(6, "é", None), (7, "", other), (None, "n", big), (None, "n", "alone" * 300), (8, "8", "é" * 500)]
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(3)


def test_archives(spark, pages, tmp_path):
    manifest = warc.write_archives(pages, str(tmp_path / "a"), roll_bytes=1500)
    again = warc.write_archives(pages, str(tmp_path / "b"), roll_bytes=1500)
    assert sorted(map(tuple, manifest.collect())) == sorted(map(tuple, again.collect()))
    (tmp_path / "a" / "pages-000000-00099.warc.gz.7.tmp").write_bytes(b"left by a lost task")
    rows = warc.read_archives(spark, str(tmp_path / "a"), payloads=True).collect()
    expected = []
    last = {}
    for r in pages.collect():
        if r.page_id is not None:
            last[r.html] = max(last.get(r.html, 0), r.page_id)
    for r in pages.collect():
        raw = (r.html or "").encode()
        to = last.get(r.html) if len(raw) >= 1000 and r.page_id != last.get(r.html) else None
        expected.append((r.page_id, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to))
        match = [x for x in rows if x.page_id == r.page_id and x.payload_digest == expected[-1][2]]
        assert match and bytes(match[0].payload) == (raw if to is None else b"")
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_archives_of_nothing(spark, pages, tmp_path):
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_damage_is_found(spark, pages, tmp_path):
    warc.write_archives(pages, str(tmp_path / "a"))
    file = next((tmp_path / "a").glob("*.warc.gz"))
    file.write_bytes(file.read_bytes()[:-20])
    with pytest.raises(Exception, match="ends within a record|records, its manifest"):
        warc.read_archives(spark, str(tmp_path / "a")).collect()


def test_chi_square():
    assert abs(ann.chi_square_quantile(0.95, 8) - 15.507) < 1e-3


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((600, 16)) * rng.uniform(0.5, 2, (600, 1))
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[40].tolist()) for i in range(60)]  # copies of one vector
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [None] * 16), (2080, [1.0]), (None, [1.0] * 16)]
    rows += [(2100, [float("inf")] + [0.0] * 15), rows[0]]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, cell int")
    got = {}
    for r in ann.nearest(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    good = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows if i is not None and v and len(v) == 16 and None not in v}
    good = {i: v for i, v in good.items() if np.isfinite(v).all() and v.any()}
    ids, matrix = np.array(list(good)), np.array(list(good.values()))
    assert sorted(got) == sorted(i for i in good if i % 20 == 0)
    hits = 0
    for q, found in got.items():
        scores = matrix @ good[q]
        order = [j for j in np.lexsort((ids, -np.round(scores, 9))) if ids[j] != q][:20]
        assert sorted(found) == list(range(1, 21))
        values = [found[k][1] for k in range(1, 21)]
        assert values == sorted(values, reverse=True)
        assert all(abs(s - good[v] @ good[q]) < 1e-9 for v, s in found.values())
        hits += len({ids[j] for j in order} & {v for v, _ in found.values()})
    assert hits >= 0.9 * 20 * len(got)


def test_neighbours_of_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(frame, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 4.0)]
    assert ann.nearest(frame.limit(0), F.lit(True)).count() == 0


def brute_force(rows, k=20):
    """Nearest by inner product among vectors of the same length, ties to the smaller id."""
    found = set()
    for q, v in rows:
        if q % 20 == 0:
            scored = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
            found |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])}
    return found


def test_equal_scores_of_different_vectors_go_to_the_smaller_id(spark):
    """600 vectors whose products with the queries are whole numbers, most of them equal."""
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, *rng.integers(-3, 4, 7).astype(float).tolist(), float(i)]) for i in range(600)]
    rows = [(i, [*v[:-1], 0.0] if i % 20 == 0 else v) for i, v in rows]
    rows = [(i, [v[0], *([0.0] * 7), v[8]] if i % 60 == 0 else v) for i, v in rows]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = {tuple(r) for r in ann.nearest(frame, F.col("vec_id") % 20 == 0, confidence=1 - 1e-12).collect()}
    assert found == brute_force(rows)


def test_vectors_of_every_length_are_searched(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-5, 6, 2 + i % 3).astype(float).tolist()) for i in range(300)]
    rows = [(i, v) for i, v in rows if any(v)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = {tuple(r) for r in ann.nearest(frame, F.col("vec_id") % 20 == 0, confidence=1 - 1e-12).collect()}
    assert found == brute_force(rows)


def grams(text):
    """Bins of the n-grams of a text, spelled out."""
    octets, found = text.lower().encode(), set()
    for n in langid.ORDERS:
        for i in range(len(octets) - n + 1):
            number = int.from_bytes(octets[i : i + n], "big") + (n << 40)
            found.add((number * 0x9E3779B97F4A7C15) % (1 << 64) >> 48)
    return found


def test_predictions_are_those_of_kernel_ridge_regression(spark):
    """Every kernel value computed from sets; ridge regression solved in the kernel's own space, not in that of bins."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 1500").orderBy("doc_id").limit(120).collect()
    docs = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in rows], "doc_id long, text string, lang string")
    known = docs.where(~langid.held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    learned = sorted({(r.lang, r.text) for r in known.collect()})
    model = langid.train(known, landmarks=10_000)
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_languages(docs, model).collect()}

    sets = [grams(t) for _, t in learned]

    def kernel(a, b):
        return len(a & b) / (max(len(a), 1) * max(len(b), 1)) ** 0.5

    gram = np.array([[kernel(a, b) for b in sets] for a in sets])
    languages = sorted({lang for lang, _ in learned})
    targets = np.array([[lang == name for name in languages] for lang, _ in learned], dtype=float)
    # With every text a landmark, the regression's weights in the feature space are those of the kernel's dual.
    weights = np.linalg.solve(gram + langid.RIDGE * np.eye(len(gram)), targets)
    for r in rows:
        text = r.text or ""
        if not regex.search(r"\p{L}", text):
            assert found[r.doc_id] == ("und", 0.0)
            continue
        own = grams(text)
        outputs = np.maximum(np.array([kernel(own, s) for s in sets]) @ weights, 0)
        best = int(outputs.argmax())
        assert found[r.doc_id][0] == languages[best]
        assert abs(found[r.doc_id][1] - outputs[best] / outputs.sum()) < 1e-3


def test_parts_of_long_texts_and_many_languages(spark, monkeypatch):
    text = "Ünïcode, ein langer Text. " * 20
    whole = {int(b) for bins in langid.presence(text) for b in bins}
    assert whole == grams(text)
    for size in (1, 3, 7, 100):
        monkeypatch.setattr(langid, "PART_BYTES", size)
        assert {int(b) for bins in langid.presence(text) for b in bins} == whole
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 10)
    docs = spark.createDataFrame([(f"l{i % 6}", f"text {i} of {i % 6}") for i in range(60)], "lang string, text string")
    assert langid._sample(docs, 400).groupBy("lang").count().where("count > 1").count() == 0
    assert len(langid.train(docs).languages) == 6


def test_languages(spark, messy, nothing):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.train(docs.where(~langid.held_out()))
    rows = langid.identify_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 40 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    found = {r.doc_id: r.lang_pred for r in langid.identify_languages(messy, model).collect()}
    assert found[4] == found[5] == found[6] == "und" and found[13] == "und"
    kept = langid.keep_identified(messy, model)
    assert kept.columns == messy.columns and kept.where("doc_id IN (4, 5, 6, 13)").count() == 0
    assert kept.count() == messy.count() - 5
    nobody = langid.train(nothing)
    assert {r.lang_pred for r in langid.identify_languages(messy, nobody).collect()} == {"und"}
    assert langid.identify_languages(nothing, model).count() == 0


def test_pipeline(spark, messy, nothing):
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language_id" and len(corpus_pipeline.STAGES) == 5
    for docs in (messy, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == messy.columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count()


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE_SQL) <= set(oracle_sql()) and set(ORACLE_SQL) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    answer = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in answer.description]
    assert sorted(map(tuple, QUERIES[name](spark, SMALL).select(*columns).collect()), key=str) == sorted(answer.fetchall(), key=str)
