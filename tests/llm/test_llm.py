"""Operators on a small table of hard cases, against plain counterparts."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from petrichor.llm import (
    attention_quality,
    chat_format,
    components,
    decontaminate,
    fertility,
    jaccard_join,
    line_dedup,
    packing,
    substring_dedup,
    suffix_dedup,
    token_counts,
)
from petrichor.llm.queries import vocabulary

PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"


def corpus():
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    bag = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(bag) for _ in range(n))
    base, passage = prose(180), prose(70)
    near = base.split()
    near[90] = "changed"
    longer = base.split()
    longer.insert(40, "added")
    line = prose(30)
    texts = [
        base, base, " ".join(near), " ".join(longer), base.upper(), None, "", " \n\t\x0b ", "word", "word", "two words",
        prose(40) + " " + passage + " " + prose(30), passage, prose(30) + "\n" + passage + "\n" + prose(5),
        line + "\n" + prose(12) + "\n\n" + line, line.replace(line.split()[4], "x", 1), " ".join(line.split()[1:]), prose(9),
        "a" * 700, "ab" * 300, "na " * 400, "é ü ñ 中文 \U0001f600 <|endoftext|> don't 42 §" * 5, prose(9000), "x\x1cy\x85z\xa0w " * 30,
        "### $$$ !!! " * 30,
    ]
    return list(enumerate(texts))


DOCS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "xx", "s", None, "clash", 1, 2, 3) for i, t in DOCS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, word string, doc long, row long, part long"
    ).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < 0")


@pytest.fixture(scope="module")
def odd(spark):
    """A row listed twice, an id with two texts, and rows without an id."""
    text = DOCS[0][1]
    rows = [(3, text), (3, text), (4, "short"), (4, text + " more"), (None, text), (None, None), (7, DOCS[12][1]), (8, DOCS[12][1])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, x) for x in r])


def test_token_counts(docs, none, odd):
    pieces = token_counts.Pieces(vocabulary(PIECES))
    want = []
    for i, t in DOCS:
        found = [brute.viterbi(w, pieces) for w in brute.words(t)]
        want.append((i, len(found), sum(a for a, _ in found), sum(b for _, b in found)))
    assert rows_of(token_counts.token_counts(docs, vocabulary(PIECES))) == want
    assert token_counts.token_counts(none, vocabulary(PIECES)).count() == 0
    assert token_counts.token_counts(odd, vocabulary(PIECES)).count() == 8


def test_fertility(docs, none, odd):
    found = {r.doc_id: r for r in fertility.fertility_rules(docs, vocabulary(PIECES)).collect()}
    for i, t in DOCS:
        assert tuple(found[i])[1:7] == brute.base_rules(t), i
        assert not (found[i].base_failed and found[i].kept)
    assert fertility.fertility_rules(none, vocabulary(PIECES)).count() == 0
    assert fertility.fertility_rules(odd, vocabulary(PIECES)).count() == 8


@pytest.mark.parametrize(("size", "percent", "most"), [(3, 90, 8_000_000), (5, 80, 8_000_000), (3, 90, 300)])
def test_jaccard(docs, size, percent, most):
    got = jaccard_join.jaccard_components(docs, size, percent, region_shingles=most)
    assert rows_of(got) == brute.jaccard_components(DOCS, size, percent)


@pytest.mark.parametrize(("size", "percent", "most"), [(3, 90, 1500), (3, 80, 1500), (3, 90, 6000)])
def test_jaccard_large_families(spark, monkeypatch, size, percent, most):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**6)}"
    dense, apart, common = [word() for _ in range(110)], [word() for _ in range(100)], [word() for _ in range(6)]
    texts = []
    for _ in range(120):  # near copies
        copy = list(dense)
        for at in rng.sample(range(110), rng.randint(1, 3)):
            copy[at] = word()
        texts.append(copy)
    chain = [word() for _ in range(110)]
    for _ in range(40):  # linked in a chain, the ends of which are not
        chain = chain[5:] + [word() for _ in range(5)]
        texts.append(list(chain))
    texts += [[*common, word(), word()] for _ in range(150)]  # not linked, by shingles of all
    texts += [[*dense[:55], *apart[at : at + 50]] for at in range(0, 50, 2)]
    texts = [(k, " ".join(t)) for k, t in enumerate(texts)]
    joined = jaccard_join._joined

    def checked(percent):
        def join(rows):
            if sum(map(len, rows.shingles)) / 8 > most:
                raise ValueError("a task holds too many shingles")
            return joined(percent)(rows)

        return join

    monkeypatch.setattr(jaccard_join, "_joined", checked)
    got = jaccard_join.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"), size, percent, region_shingles=most)
    assert rows_of(got) == brute.jaccard_components(texts, size, percent)


def test_components(spark):
    links = [(i, i + 1) for i in range(300) if i % 100 != 99] + [(1000 + i, 1000 + i // 3) for i in range(50)] + [(7, 7)]
    edges = spark.createDataFrame(links, "a long, b long").repartition(5)
    found = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert found == {i: i // 100 * 100 for i in range(300)} | {1000 + i: 1000 for i in range(50)}


def test_jaccard_edges(none, odd):
    assert jaccard_join.jaccard_components(none).count() == 0
    pairs = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted(brute.jaccard_components(pairs, 3, 90), key=lambda r: [(x is not None, x) for x in r])
    assert rows_of(jaccard_join.jaccard_components(odd, 3, 90)) == want
    assert jaccard_join.keep_first(odd).count() == 4  # one long text, one of the last two, "short", the row without a text


def test_suffixes(docs, none, odd):
    got = suffix_dedup.suffix_dedup(docs).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), r.n_spans, brute.sha(bytes(r.kept))) for r in got) == brute.suffix_dedup(DOCS)
    assert suffix_dedup.suffix_dedup(none).count() == 0
    twice = {(r.doc_id, r.n_bytes, len(r.kept)) for r in suffix_dedup.suffix_dedup(odd).collect()}
    assert {x for x in twice if x[0] == 3} == {(3, len(DOCS[0][1]), 0)}


@pytest.mark.parametrize("memory", [10**6, 10])
def test_column_wise_order(memory):
    import numpy as np

    rng = np.random.default_rng(2)
    parts = [bytes(rng.integers(97, 99, n).tolist()) for n in (0, 1, 7, 30, 30, 64)] + [b"abab" * 9]
    text, ends = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])
    at, shared = suffix_dedup.collection_order(text, ends, 20, memory)
    starts = ends - [len(p) for p in parts]
    suffixes = [(p[i:], k) for k, p in enumerate(parts) for i in range(len(p))]
    got = []
    for a in at[len(parts) :]:
        k = int(np.searchsorted(ends, a, "right"))
        got.append(parts[k][a - starts[k] :])
    assert got == [s for s, _ in sorted(suffixes)]
    for x, y, n in zip(got, got[1:], shared[len(parts) + 1 :]):
        same = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        assert n == min(same, 20)


def test_substrings(docs, none, odd):
    got = [(r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in substring_dedup.substring_dedup(docs).collect()]
    assert sorted(got) == brute.substring_dedup(DOCS)
    assert substring_dedup.substring_dedup(none).count() == 0
    pairs = [(r.doc_id, r.text) for r in odd.collect()]
    got = rows_of(substring_dedup.substring_dedup(odd).select("doc_id", "n_words", "n_removed"))
    assert got == sorted((r[:3] for r in brute.substring_dedup(pairs)), key=lambda r: [(x is not None, x) for x in r])


def test_lines(docs, none, odd):
    got = {r.doc_id: (r.n_lines_with_words, r.n_lines_removed, r.text or "") for r in line_dedup.dedup_lines(docs).collect()}
    assert got == brute.line_dedup(DOCS)
    assert line_dedup.dedup_lines(none).count() == 0
    assert line_dedup.dedup_lines(odd).count() == 8


def test_short_lines(spark):
    """Lines of five words may differ by one, lines of four must be equal; a line of six may have one of five within it."""
    lines = ["a b c d e", "a b c d x", "a b c d", "a b c x", "q a b c d e", "a c b d e", "", "a b  c d", "p q r s t u", "p q r s t", "q r s t"]
    pairs = [(i, line) for i, line in enumerate(lines)] + [(90, "\n".join(lines)), (91, None)]
    table = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_lines_with_words, r.n_lines_removed, r.text or "") for r in line_dedup.dedup_lines(table).collect()}
    assert got == brute.line_dedup(pairs)
    assert got[1][1] == got[4][1] == got[9][1] == 1 and got[3][1] == got[5][1] == got[10][1] == 0


def test_containment(docs, none, odd, spark):
    items = [(1, DOCS[12][1]), (2, "two words"), (3, ""), (4, None), (5, " ".join(DOCS[12][1].split()[:20] + ["q"] * 2)), (6, "WORD")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r)[:4] for r in decontaminate.containments(docs, table).collect()}
    assert got == brute.containments(DOCS, items)
    assert decontaminate.containments(none, table).count() == decontaminate.containments(docs, table.where("item_id < 0")).count() == 0
    clean = decontaminate.drop_contaminated(docs, table)
    assert clean.columns == docs.columns and clean.count() == len(DOCS) - len({d for d, *_ in got})
    assert decontaminate.drop_contaminated(odd, table).count() == 6


def test_quality(spark, none, odd):
    rng = random.Random(1)
    good = lambda: " ".join(rng.choice(["river", "house", "walks", "slowly", "The"]) + rng.choice(["", ",", "."]) for _ in range(150))
    bad = lambda: " ".join(rng.choice(["BUY", "$$$", "###", "NOW"]) + "!!" for _ in range(150))
    rows = [(i, good() if i % 2 else bad()) for i in range(240)] + [(None, None), (500, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(240)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = attention_quality.classify(table, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    judged = [r for r in got if r.held_out and r.doc_id < 240]
    assert len(judged) > 30 and all(r.predicted == r.doc_id % 2 for r in judged)
    assert all(r.held_out == brute.held_out(r.doc_id) for r in got)
    assert {r.score for r in attention_quality.classify(odd, labels.where("doc_id < 0")).collect()} == {0.5}
    assert attention_quality.classify(none, labels).count() == 0


def test_attention_against_plain_loops():
    """Scores by one passage after the other, and gradients by differences of the loss."""
    rng = np.random.default_rng(4)
    width = attention_quality.WIDTH
    model = attention_quality.GatedAttention(rng.normal(size=width), rng.uniform(0.5, 2, width), 3)
    sizes = [1, 4, 2]
    x, y = rng.normal(size=(sum(sizes), width)), np.array([1.0, 0.0, 1.0])
    starts, doc = np.cumsum([0, *sizes[:-1]]), np.repeat(np.arange(3), sizes)
    want = [brute.attention_score(x[a : a + n].tolist(), model) for a, n in zip(starts, sizes)]
    assert np.allclose(model.scores(x, starts, doc), want, rtol=1e-12)
    found = model.gradients(x, starts, doc, y)

    def loss():
        s = model.scores(x, starts, doc)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for name, weights in model.p.items():
        flat, own = weights.reshape(-1), found[name].reshape(-1)
        for k in rng.choice(len(flat), min(12, len(flat)), replace=False):
            kept, h = flat[k], 1e-5
            flat[k] = kept + h
            above = loss()
            flat[k] = kept - h
            below = loss()
            flat[k] = kept
            assert abs((above - below) / (2 * h) - own[k]) < 1e-7, name


def test_passages_of_long_and_empty_texts():
    long = " ".join(["Word,"] * 20_001)
    x, doc = attention_quality.passages(pa.array([long, None, "", "one"]))
    assert np.bincount(doc).tolist() == [201, 1, 1, 1] and np.isfinite(x).all()
    alone, _ = attention_quality.passages(pa.array([long]))
    assert np.array_equal(alone, x[:201])


def test_quality_reads_text_alone(spark):
    """Columns named like the helpers, a very long text, ties and repeated rows."""
    texts = ["river house walks slowly " * 40, "BUY $$$ ### NOW!! " * 40]
    rows = [(i, texts[i % 2], "x", 0.5, i, i) for i in range(80)] + [(200, texts[0] * 400, None, None, None, None), (1, texts[1], "x", 0.5, 1, 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, label int, at int").repartition(3)
    labels = spark.createDataFrame([(i, 1 - i % 2, i) for i in range(80)], "doc_id long, quality int, score int")
    got = attention_quality.classify(table, labels, steps=200).collect()
    assert len(got) == 82 and len({r.score for r in got if r.doc_id < 200}) <= 4
    assert all(r.predicted == 1 - r.doc_id % 2 for r in got)
    kept = attention_quality.keep_good(table, labels, steps=200)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == [*range(0, 80, 2), 200]


def test_chats(spark):
    hard = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|im_start|> <|im_end|", "<", "<|im_end|>\n", "", None, "plain\n\ntext"]
    rows = [(c, t, r, x) for c, x in enumerate(hard) for t, r in ((0, "user"), (1, "assistant"), (1, "assistant"), (None, "system"))]
    rows += [(None, 0, None, "x"), (90, 0, "as\nsistant%0A", "y"), (91, 0, "<|im_end|>", "z"), (92, 0, "assistant", "%25")]
    chats = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, plain int")
    out = chat_format.format_chats(chats)
    got = out.select("conv_id", "identical", chat_format.parsed(out.formatted).alias("turns"), chat_format.loss_text(out.formatted, out.loss_spans).alias("loss")).collect()
    want = brute.chat_digests(rows)
    assert len(got) == len(want) and all(r.identical for r in got)
    for r in got:
        told = "".join(f"{t.role}\n{t.text}\n" for t in r.turns)
        assert (len(r.turns), brute.sha(told), len(r.loss), brute.sha(r.loss)) == want[r.conv_id]
    assert chat_format.format_chats(chats.where("conv_id < 0")).count() == 0


def test_packing(docs, none, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(WORDS))
    for table, pairs in ((docs, DOCS), (odd, [(r.doc_id, r.text) for r in odd.collect()])):
        got = packing.pack(table, vocabulary(WORDS), block_items=8).collect()
        assert sorted((tuple(r)[:5] for r in got), key=lambda x: (brute._order(x[0]), x[1:])) == brute.pieces_of(pairs, tokenizer)
        held = {}
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == held.get(r.sequence_id, 0)
            held[r.sequence_id] = r.offset + r.length
        assert max(held.values()) <= 4096
        assert len(held) <= -(-sum(held.values()) // 4096) + 2
    assert packing.pack(none, vocabulary(WORDS)).count() == 0


def test_evolution_beats_its_start():
    lengths = [35, 35, 30, 33, 33, 34, 50, 50, 60, 40, 70, 20, 10] * 3
    start = packing.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 100, [])
    best = packing.evolved(lengths, 100, [], 200, 6, 1)
    assert packing.fitness(best, lengths, 100) <= packing.fitness(start, lengths, 100)
    assert sorted(i for held in best for i in held) == list(range(len(lengths)))


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    ids = {r.doc_id for r in rows}
    assert len(rows) > 50 and len(ids) <= 200
    assert all(r.length <= 4096 for r in rows)


def test_stages_two_to_four_against_a_plain_chain(spark, tmp_path):
    """Lines, near duplicates and decontamination one after the other, each on what the one before kept."""
    import corpus_pipeline

    items = [(1, DOCS[12][1]), (2, "two words"), (3, ""), (4, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table = spark.createDataFrame([(i, t, len(t or "")) for i, t in DOCS], "doc_id long, text string, n_chars long").repartition(3)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        table = stage(spark, table, str(tmp_path))
        table.write.parquet(str(tmp_path / name.replace(" ", "-")))
        table = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
        assert table.columns == ["doc_id", "text", "n_chars"]
    got = {r.doc_id: (r.text, r.n_chars) for r in table.collect()}

    texts = dict(DOCS)
    lines = brute.line_dedup(DOCS)
    kept = [(i, texts[i] if not gone else text) for i, (full, gone, text) in lines.items() if not (gone and gone == full)]
    roots = {r[0]: r[2] for r in brute.jaccard_components(kept, 5, 80)}
    kept = [(i, t) for i, t in kept if roots[i] == i]
    leaky = {d for d, *_ in brute.containments(kept, items)}
    assert got == {i: (t, len(t or "")) for i, t in kept if i not in leaky} and leaky


@pytest.mark.parametrize("percent", [50, 80, 90, 97])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(5)
    classes, pairs = jaccard_join._classes(percent, 2000), 0
    for n in [*range(1, 130), 400, 1000]:
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        for less in {0, 1, int(rng.integers(0, n)), n * (100 - percent) // 100, n * (100 - percent) // (100 + percent)}:
            for more in {0, 1, int(rng.integers(0, n)), less, n * (100 - percent) // percent}:
                y = np.concatenate((rng.choice(x, n - less, replace=False), rng.integers(0, 1 << 63, more).astype(np.uint64) * np.uint64(2)))
                y = np.unique(y)
                shared = len(np.intersect1d(x, y))
                if np.array_equal(x, y) or 100 * shared < percent * (len(x) + len(y) - shared):
                    continue
                pairs += 1
                a, b = (jaccard_join._signatures(s, percent, classes) for s in (x, y))
                assert np.intersect1d(a, b).size, (n, less, more)
    assert pairs > 100


def test_unlike_texts_of_common_passages_are_no_family(spark, monkeypatch):
    rng = random.Random(3)
    passages = [[f"w{rng.randrange(10**6)}" for _ in range(8)] for _ in range(100)]
    texts = [(k, " ".join(w for p in rng.sample(passages, 10) for w in p)) for k in range(80)]
    texts += [(100 + k, t + " end") for k, t in texts[:5]]

    def large(*_):
        raise AssertionError("unlike texts were chained to a large family")

    monkeypatch.setattr(jaccard_join, "_large_links", large)
    got = jaccard_join.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"), 3, 90, region_shingles=2000)
    assert rows_of(got) == brute.jaccard_components(texts, 3, 90)
