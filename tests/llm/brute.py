"""Plain counterparts of the operators, for small inputs: one document, one pair, one window at a time."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def base_rules(text):
    text = text or ""
    found = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    covered = {j for i in range(len(found) - 7) if grams[tuple(found[i : i + 8])] > 1 for j in range(i, i + 8)}
    n = len(found)
    return (
        n, sum(map(len, found)), sum(c in "#*$%&|<>" for w in found for c in w), len(lines) - len(set(lines)), len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


def viterbi(word, pieces):
    """Tokens and byte tokens of the best segmentation of a word, by all ways to its end."""
    word = "▁" + word
    best = [(0.0, 0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        ways = [(best[end - 1][0] + n * pieces.byte_score, 0, best[end - 1][1] + n, best[end - 1][2] + n)]
        for size in range(1, end + 1):
            score = pieces.scores.get(word[end - size : end])
            if score is not None:
                past = best[end - size]
                ways.append((past[0] + score, size, past[1] + 1, past[2]))
        top = max(ways, key=lambda w: (w[0], w[1]))
        best.append((top[0], top[2], top[3]))
    return best[-1][1:]


def shingles(text, size):
    found = [w.translate({c: c + 32 for c in range(65, 91)}) for w in words(text)]
    if len(found) < size:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def jaccard_components(docs, size, percent):
    """(doc_id, n_shingles, component_id) of each (doc_id, text), over all pairs."""
    sets = [shingles(t, size) for _, t in docs]
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    out = []
    for i, (key, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if root[j] == root[i] and docs[j][0] is not None]
        out.append((key, len(sets[i]), (min(ids) if ids else None) if sets[i] else key))
    return out


def _order(key):
    return (key is not None, key or 0)


def suffix_dedup(docs, window=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256); ids are distinct."""
    seen, out = set(), []
    for key, text in sorted(docs, key=lambda d: _order(d[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            s = data[i : i + window]
            if s in seen:
                gone[i : i + window] = b"\1" * window
            seen.add(s)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(data), sum(gone), spans, sha(bytes(c for c, g in zip(data, gone) if not g))))
    return out


def substring_dedup(docs, window=50):
    """(doc_id, n_words, n_removed, kept_sha256)."""
    first = {}
    for key, text in docs:
        found = words(text)
        for i in range(len(found) - window + 1):
            s = tuple(found[i : i + window])
            if s not in first or _order(key) < first[s]:
                first[s] = _order(key)
    out = []
    for key, text in docs:
        found = words(text)
        gone = set()
        for i in range(len(found) - window + 1):
            if first[tuple(found[i : i + window])] < _order(key):
                gone.update(range(i, i + window))
        out.append((key, len(found), len(gone), sha(" ".join(w for i, w in enumerate(found) if i not in gone))))
    return out


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def line_dedup(docs, least_words=5):
    """{doc_id: (lines with words, lines removed, kept text)}; ids are distinct."""
    seen, out = [], {}
    for key, text in sorted(docs, key=lambda d: _order(d[0])):
        kept, full, gone = [], 0, 0
        for line in (text or "").split("\n"):
            found = words(line)
            full += bool(found)
            repeat = any(found == x or (min(len(found), len(x)) >= least_words and _one_edit(found, x)) for x in seen if abs(len(x) - len(found)) <= 1)
            if found and repeat:
                gone += 1
            else:
                kept.append(line)
            if found:
                seen.append(found)
        out[key] = (full, gone, "\n".join(kept))
    return out


def containments(docs, items, size=5, threshold=0.8):
    """{(doc_id, item_id, n_item_shingles, n_shared)}."""
    out = set()
    held = [(i, shingles(t, size)) for i, t in items]
    for key, text in docs:
        own = set().union(*(shingles(text, n) for n in range(1, size + 1)))
        out |= {(key, i, len(s), len(s & own)) for i, s in held if s and len(s & own) >= threshold * len(s) - 1e-9}
    return out


def chat_digests(rows):
    """{conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)} of (conv_id, turn, role, text)."""
    out = {}
    for key in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0), r[2] or "", r[3] or "") for r in rows if r[0] == key)
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[key] = (len(turns), sha(told), len(loss), sha(loss))
    return out


def held_out(key):
    return key is not None and zlib.crc32(str(key).encode()) % 4 == 2


def pieces_of(docs, tokenizer, most=4096, end_id=1):
    """{(doc_id, piece, start, length, ids_crc32)}: whole texts through the whole tokeniser."""
    out = []
    for key, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        for k in range(0, len(ids), most):
            part = ids[k : k + most]
            out.append((key, k // most, k, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))))
    return sorted(out, key=lambda x: (_order(x[0]), x[1:]))


def entropy(tokens):
    n = len(tokens)
    return -sum(c / n * math.log2(c / n) for c in Counter(tokens).values()) if n else 0.0


def _script(found, scripts):
    import regex

    counts = {name: sum(bool(regex.search(pattern, w)) for w in found) for name, pattern in scripts.items()}
    best = max(counts, key=lambda name: counts[name])
    return best if counts[best] else "other"


def fertility_kept(docs, pieces, ranks, scripts, slack, width=1.5, blend=200.0):
    """{doc_id: kept} of (doc_id, text, lang): every word encoded by itself, quartiles by sorting."""
    rows = []
    for key, text, lang in docs:
        found = words(text)
        ids = [i for w in found for i in pieces.encode(w)]
        n, chars = len(ids), sum(map(len, found))
        measures = [
            chars / max(n, 1), sum(map(pieces.is_byte, ids)) / max(n, 1), entropy(ids) / math.log2(max(n, 2)),
            chars / max(sum(len(ranks.encode_ordinary(" " + w)) for w in found), 1),
        ]
        rows.append((key, lang or "", _script(found, scripts), n.bit_length(), base_rules(text), measures))

    def band(group, i):
        ordered = sorted(r[5][i] for r in group)
        low, high = (ordered[math.ceil(p * len(ordered)) - 1] for p in (0.25, 0.75))
        reach = max(width * (high - low), slack[i])
        return low - reach, high + reach

    out = {}
    fit = [r for r in rows if r[4][0] >= 20]
    for key, lang, script, size, base, measures in rows:
        wide = [r for r in fit if r[2:4] == (script, size)]
        fine = [r for r in wide if r[1] == lang]
        share = len(fine) / (len(fine) + blend)
        inside = bool(fine)
        for i in range(len(measures) if fine else 0):
            low, high = (share * a + (1 - share) * b for a, b in zip(band(fine, i), band(wide, i)))
            inside &= low - 1e-12 <= measures[i] <= high + 1e-12
        out[key] = inside and not base[-1]
    return out


def exact_groups(rows):
    """(doc_id, keep_id, group_size, kept, sha256) of each (doc_id, text); rows without an id come last."""
    told = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out = []
    for at, (i, body) in enumerate(told):
        group = sorted((j is None, j or 0, k) for k, (j, other) in enumerate(told) if other == body)
        keep = told[group[0][2]][0]
        out.append((i, keep, len(group), group[0][2] == at, sha(body)))
    return out


def spelling_forms(docs, least_letters=6, least_count=5, factor=5):
    """(word, form, root, n, n_near, form_n) of each frequent word, over all pairs of words."""
    counts = Counter()
    for i, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= least_letters and n >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    form, n_near = {}, {}
    for w, n in kept.items():
        found = sorted((-m, v) for v, m in kept.items() if near(v, w))
        n_near[w] = len(found)
        form[w] = found[0][1] if found and -found[0][0] >= factor * n else None
    out = []
    for w, n in kept.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, n_near[w], kept[form[w]] if form[w] else None))
    return out


def whitened(rows, components=4, scale=256):
    """n, rows that stay as (vec_id, x, deviation), eigenvalues, vectors, trace: by a full decomposition of the covariance."""
    import numpy as np

    whole = [(i, tuple(math.floor(scale * c) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    if not whole:
        return 0, [], None, None, 0.0
    usual = min(Counter(len(x) for _, x in whole).items(), key=lambda m: (-m[1], m[0]))[0]
    whole = [(i, x) for i, x in whole if len(x) == usual]
    fit = sorted({x for _, x in whole})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    told = [(i, x, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in whole]
    centred = np.array(fit, float) - np.array(sums, float) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    return n, told, values[::-1][:components], vectors[:, ::-1][:, :components], np.trace(cov)


def attention_score(passages, model):
    """The score of one document, number by number."""
    def sigmoid(v):
        return 1 / (1 + math.exp(-v))

    def product(row, name):
        return [sum(r * m for r, m in zip(row, column)) for column in model.p[name].T.tolist()]

    hidden, energy = [], []
    for x in passages:
        x = [(v - m) / s for v, m, s in zip(x, model.mean.tolist(), model.std.tolist())]
        h = [math.tanh(v + b) for v, b in zip(product(x, "A"), model.p["a"].tolist())]
        hidden.append(h)
        gates = zip(product(h, "V"), product(h, "U"), model.p["w"].tolist())
        energy.append(sum(math.tanh(t) * sigmoid(s) * w for t, s, w in gates))
    total = sum(math.exp(e) for e in energy)
    z = [sum(math.exp(e) / total * h[k] for e, h in zip(energy, hidden)) for k in range(len(hidden[0]))]
    return sigmoid(sum(a * b for a, b in zip(z, model.p["c"].tolist())) + float(model.p["c0"][0]))
