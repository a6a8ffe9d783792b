"""Exact copies, spelling variants and whitening against plain counterparts."""

import random

import brute
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from petrichor.llm import exact_dedup, packing, queries, spelling, substring_dedup, suffix_dedup, whitening

CLASHING = "doc_id long, text string, hash string, row long, held long, first string, body string, sha string, word string, n long, r string"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", "z", "s", "w", 3, "r") for i, t in rows], CLASHING).repartition(3)


def copies():
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 50)) for _ in range(n))
    base = prose(30)
    texts = [base, base.replace(" ", " \t\n"), base + " ", " " + base, base.upper(), None, "", " ", "\n", base.replace(" ", "\xa0"), prose(20_000)]
    texts += [f"{base}\r\n{k % 7}" for k in range(60)] + ["hot copy"] * 200
    return [(1000 - i, t) for i, t in enumerate(texts)]


def keys(rows):
    return sorted(tuple(map(repr, r)) for r in rows)


class TestExact:
    COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]

    @pytest.mark.parametrize("bits", [128, 8, 4])
    def test_against_plain(self, spark, bits, monkeypatch):
        monkeypatch.setattr(exact_dedup, "SALTED_ROWS", 20)
        got = exact_dedup.exact_groups(clashing(spark, copies()), bits=bits)
        assert got.columns == self.COLUMNS
        assert keys(got.collect()) == keys(brute.exact_groups(copies()))

    def test_repeated_rows_and_missing_ids(self, spark):
        rows = [(5, "a b"), (5, "a  b"), (5, "a b"), (None, "a\tb"), (None, None), (None, ""), (2, "c"), (2, "d")]
        for bits in (128, 4):
            got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), bits=bits).collect()
            want = brute.exact_groups(rows)
            # Which of the rows that are listed twice stays is left open: it is one.
            assert keys(r[:3] + r[4:] for r in got) == keys(r[:3] + r[4:] for r in want)
            assert sum(r.kept for r in got) == sum(r[3] for r in want) == 4

    def test_shuffled_sides(self, spark, monkeypatch):
        monkeypatch.setattr("petrichor.llm.sides.BROADCAST_BYTES", 0)
        got = exact_dedup.exact_groups(clashing(spark, copies()))
        assert keys(got.collect()) == keys(brute.exact_groups(copies()))

    def test_rows_that_stay(self, spark):
        docs = clashing(spark, copies())
        kept = exact_dedup.drop_copies(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in brute.exact_groups(copies()) if r[3])
        twice = exact_dedup.drop_copies(docs.unionAll(docs))
        assert twice.columns == docs.columns and twice.count() == kept.count()

    def test_empty(self, spark):
        none = clashing(spark, copies()).where("doc_id < 0")
        assert exact_dedup.exact_groups(none).collect() == [] == exact_dedup.drop_copies(none).collect()

    def test_native(self, spark):
        plan = exact_dedup.exact_groups(clashing(spark, copies()))._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def spelled():
    rng = random.Random(9)
    words = ["weather", "rainfall", "Straße", "ÀÉÎõü×÷", "observation", "umbrella", "umbrellas", "forecast", "station", "abcabcabc", "naïveté"]
    out = []
    for i in range(400):
        body = []
        for _ in range(30):
            w = rng.choice(words[: 1 + int(len(words) * rng.random())])
            if rng.random() < 0.08:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("aeé") + w[k:], w[:k] + rng.choice("aeé") + w[k + 1 :]])
            body.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i, rng.choice([" ", ", ", "-", "\n"]).join(body)))
    out += [(500, "colourful " * 6), (501, "colourfull " * 40), (502, "colourfulls " * 300)]
    return out + [(400, None), (401, ""), (402, "a b c Āā 1234567"), (403, "longest" * 4000), (None, "weather " * 9), (7, "weather rainfall")]


class TestSpelling:
    def test_against_plain(self, spark):
        docs = spelled()
        want = brute.spelling_forms(docs)
        assert any(r[1] for r in want) and any(r[2] not in (r[0], r[1]) for r in want)
        got = spelling.spelling_forms(clashing(spark, docs))
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert keys(got.collect()) == keys(want)

    @pytest.mark.parametrize("symbols, limit", [(2, 32 << 20), (8, 0)])
    def test_alphabets_and_shuffled_sides(self, spark, monkeypatch, symbols, limit):
        monkeypatch.setattr("petrichor.llm.sides.BROADCAST_BYTES", limit)
        got = spelling.spelling_forms(clashing(spark, spelled()), factor=2, symbols=symbols)
        assert keys(got.collect()) == keys(brute.spelling_forms(spelled(), factor=2))

    def test_typos_lower_length_and_count(self, spark):
        docs = [(i, "Umbrella ÉCLAIRS") for i in range(3000)]
        want = brute.spelling_forms(docs)
        assert len(want) >= 3
        assert keys(spelling.spelling_forms(spark.createDataFrame(docs, "doc_id long, text string")).collect()) == keys(want)

    def test_empty(self, spark):
        assert spelling.spelling_forms(clashing(spark, spelled()).where("doc_id < 0")).collect() == []


def vectors():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 12)) * np.array([3, 2, 2, 1.5] + [1.0] * 8) * 0.3 + 5
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    rows += [(500 + i, rows[i][1]) for i in range(40)] + [(900 + i, rows[0][1]) for i in range(300)] + [(0, rows[0][1]), (None, rows[5][1])]
    return rows + [(1, None), (2, []), (3, [None] * 12), (4, [float("nan")] + [1.0] * 11), (5, [float("inf")] * 12), (6, [1.0, 2.0])]


def check(got, rows, components=4):
    n, told, values, turns, trace = brute.whitened(rows, components)
    k = int((values > 1e-12 * trace).sum())
    assert len(got) == len(told) * k
    assert {r.n for r in got} == {n}
    assert keys((r.vec_id, int(r.deviation)) for r in got) == keys((i, d) for i, _, d in told for _ in range(k))
    for r in got:
        assert abs(r.explained - values[r.component - 1] / trace) <= 1e-12
        assert r.identity_error <= 1e-9
    mean = np.unique([x for _, x, _ in told], axis=0).mean(axis=0)
    want = {}
    for i, x, d in told:
        want.setdefault((i, d), []).append((np.array(x) - mean) @ turns[:, :k] / np.sqrt(values[:k]))
    signs = np.zeros(k)
    for r in got:
        w = want[r.vec_id, int(r.deviation)][0][r.component - 1]
        if abs(w) > 0.3 and not signs[r.component - 1]:
            signs[r.component - 1] = np.sign(w * r.whitened)
    for r in got:
        near = [abs(w[r.component - 1] * signs[r.component - 1] - r.whitened) for w in want[r.vec_id, int(r.deviation)]]
        assert min(near) < 1e-8


class TestWhitening:
    SCHEMA = "vec_id long, embedding array<float>, label int, x int, n long, component int, v string"

    def frame(self, spark, rows):
        return spark.createDataFrame([(i, v, 1, 2, 3, 4, "v") for i, v in rows], self.SCHEMA).repartition(3)

    def test_against_full_decomposition(self, spark):
        got = whitening.whiten(self.frame(spark, vectors())).collect()
        check(got, vectors())

    def test_few_dimensions_and_no_variance(self, spark):
        flat = [(i, [float(i % 5), 1.0, float(i % 3)]) for i in range(40)]
        check(whitening.whiten(self.frame(spark, flat)).collect(), flat)
        for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, None)]):
            assert whitening.whiten(self.frame(spark, rows)).collect() == []

    def test_equal_eigenvalues(self, spark):
        rows = [(i, [float(8 * (i == j)) for j in range(6)]) for i in range(6)] + [(9, [0.0] * 6)]
        got = whitening.whiten(self.frame(spark, rows)).collect()
        assert len(got) == 7 * 4 and max(r.identity_error for r in got) < 1e-9

    def test_exact_beyond_64_bits(self):
        x, sums = np.array([[1 << 40, -5]]), np.array([3 << 40, 7])
        assert whitening.deviations(x, 1 << 20, sums) == [((1 << 60) - (3 << 40)) ** 2 + (-5 * (1 << 20) - 7) ** 2]

    @pytest.mark.parametrize("dim, gap", [(5, 0.5), (40, 0.02), (200, 0.01)])
    def test_pairs_of_a_known_matrix(self, dim, gap):
        rng = np.random.default_rng(dim)
        turn, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
        values = 1 / (1 + gap * np.arange(dim))
        matrix = (turn * values) @ turn.T
        found, axes = whitening.leading_pairs(lambda b: matrix @ b, dim, 4)
        assert np.allclose(found, values[:4], rtol=1e-12)
        assert np.linalg.norm(matrix @ axes - axes * found, axis=0).max() < 1e-12

    def test_query(self, spark):
        got = queries.QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.001")
        assert dict(got.dtypes) == {
            "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double",
        }
        rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
        check(got.collect(), [tuple(r) for r in rows])


def long_runs():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [prose(n) for n in (300, 700, 1300)]
    texts = [prose(40) + " " + rng.choice(passages) + " " + prose(30) for _ in range(14)] + [passages[1][40:], "ab " * 900, "na" * 900]
    return list(enumerate(texts))


@pytest.mark.parametrize("window", [158, 159, 200, 256, 300, 600])
def test_suffixes_of_long_windows(spark, window):
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(long_runs(), "doc_id long, text string"), window=window)
    found = [(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), r.n_spans, brute.sha(bytes(r.kept))) for r in got.collect()]
    assert keys(found) == keys(brute.suffix_dedup(long_runs(), window)) and any(r[2] for r in found)


@pytest.mark.parametrize("window", [128, 150, 160, 220, 600])
def test_substrings_of_long_windows(spark, window):
    got = substring_dedup.substring_dedup(spark.createDataFrame(long_runs(), "doc_id long, text string"), window=window)
    found = [(r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in got.collect()]
    assert keys(found) == keys(brute.substring_dedup(long_runs(), window)) and any(r[2] for r in found)


def test_stages_take_clashing_columns(spark):
    docs = clashing(spark, copies() + [(2000, "a line of its own\nhot copy\nhot copy")])
    for name in ("_gone", "_doc", "_part", "_row", "n_lines_removed", "n_lines_with_words", "n_chars"):
        docs = docs.withColumn(name, F.lit(7).cast("long"))
    for rows in (docs, docs.unionAll(docs), docs.where("doc_id < 0")):
        lines = corpus_pipeline.fresh_lines(spark, rows, "")
        assert lines.columns == docs.columns
        assert lines.where("_gone = 7 and n_lines_removed = 7").count() == lines.count()
        kept = corpus_pipeline.distinct_documents(spark, rows, "")
        assert kept.columns == docs.columns and kept.count() <= rows.count()
        assert exact_dedup.drop_copies(rows).columns == docs.columns


def test_packing_refuses_vocabularies_that_it_would_misread():
    with pytest.raises(ValueError):
        packing.WordIds(queries.vocabulary("byte_bpe_50k.json"))


def test_spelling_query_on_the_smallest_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = queries.QUERIES["op12_spelling_variants"](spark, "/root/testdata/sf0.001").where(F.col("n") >= 40)
    words = {r.word: r for r in got.collect()}
    assert words and all(words[r.form].n == r.form_n for r in words.values() if r.form)
    assert docs.count() == 200


def test_fertility_verdicts(spark):
    import sentencepiece

    from petrichor.llm import fertility

    rng = random.Random(3)
    bags = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(300)] for lang, letters in (
        ("xx", "abcdefghijklmnop"), ("yy", "eiouzvwk"), (None, "абвгдежзи"))}
    rows = []
    for i in range(360):
        lang = rng.choice([*bags])
        found = [rng.choice(bags[lang]) for _ in range(rng.choice((10, 60, 90, 400)))]
        if i % 12 == 0:
            found = [w if rng.random() < 0.6 else rng.choice(("$$#|", "x9&q%", "中文", "<>")) for w in found]
        rows.append((i, " ".join(found), lang))
    rows += [(900, None, "xx"), (901, "", None), (902, "one two " * 40, "xx"), (903, "z" * 5000 + " q" * 30, "yy")]
    paths = queries.vocabulary("piece_bpe_32k.model"), queries.vocabulary("byte_bpe_multi_50k.tiktoken")
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, script string, band int").repartition(5)
    want = brute.fertility_kept(
        rows, sentencepiece.SentencePieceProcessor(model_file=paths[0]), fertility.Ranks(paths[1])._model, fertility.SCRIPTS,
        [*fertility.SLACK.values(), fertility.SLACK["chars_per_token"]],
    )
    found = fertility.fertility_rules(docs, paths[0], others=[paths[1]]).collect()
    assert {r.doc_id: r.kept for r in found} == want
    assert sum(not r.base_failed and not r.kept for r in found) > 10 and sum(r.kept for r in found) > 150


def test_short_items_inside_documents(spark):
    from petrichor.llm import decontaminate

    items = [(1, "What is photosynthesis"), (2, "oxygen"), (3, "the light of day"), (4, "a b c d e f"), (5, ""), (6, None), (7, "b b")]
    docs = [
        (1, "He asked: what is photosynthesis and why"), (2, "what is  photosynthesis?"), (3, "Oxygen"), (4, "in the light\tof day " * 50 + "oxygen oxygen"),
        (5, "what is"), (6, None), (7, "x a b c d e f b b b"), (8, "oxygenated light of day"),
    ]
    held = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, words int")
    wanted = spark.createDataFrame(items, "item_id long, text string")
    found = {tuple(r)[:4] for r in decontaminate.containments(held, wanted).collect()}
    assert found == brute.containments(docs, items)
    assert {(a, b) for a, b, *_ in found} == {(1, 1), (3, 2), (4, 2), (4, 3), (7, 4), (7, 7)}
    assert {r.doc_id for r in decontaminate.drop_contaminated(held, wanted).collect()} == {2, 5, 6, 8}
