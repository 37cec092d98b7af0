"""The prefix trie, the source audit and language-model scores against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidefeed.llm import pitman_yor as py
from tidefeed.llm import queries as q
from tidefeed.llm import source_audit as audit
from tidefeed.llm.perfect_hash import Table, build, hashes, stored
from tidefeed.llm.pitman_yor import Room, scored_texts, seated
from tidefeed.llm.prefix_trie import MESSAGE, Queue, restarted_trie
from tidefeed.llm.source_audit import source_divergence

TURNS = "conv_id LONG, turn LONG, role STRING, text STRING, depth LONG, n_convs STRING"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# The trie


def some_conversations():
    """Nulls, ties, repeated rows, shared starts, copies, a long conversation, absent bases."""
    rng = random.Random(5)
    rows = [(None, 0, "user", "no id"), (7, None, None, None), (7, 0, "a", "x"), (7, 0, "a", "x"),
            (7, 3, "a", None), (312, 0, "user", "é漢😀"), (205, 0, "user", "alone")]
    for c in [0, 1, 2, 3, 4, 5, 6, 100, 101, 102, 103, 150]:
        rows += [(c, t, rng.choice("ab"), rng.choice(["hello", "hi", "h"])) for t in range(rng.randint(0, 7))]
    for c in range(1000, 1090):  # copies, and a hot start
        rows += [(c, t, "user", f"turn {t}" if t < 6 or c % 3 else f"own {c % 9}") for t in range(9)]
    rows += [(2000, t, "user", f"long {t % 7}") for t in range(300)]
    rows += [(2001, t, "user", f"long {t % 7}") for t in range(260)]
    return [(*r, 99, "clash") for r in rows]


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [(r, t) for _, r, t in sorted(x)] for c, x in own.items()}
    paths = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(turns.get(c - c % 100, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if paths[c] == p))).encode()).hexdigest())
        for p, m in members.items()
    )


def trie_of(spark, rows, **options):
    start = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    base = F.col("conv_id") - F.col("conv_id") % 100
    found = restarted_trie(spark.createDataFrame(rows, TURNS), start, 5, base, **options).collect()
    return sorted(tuple(-1 if x is None else x for x in row) for row in found)


@pytest.mark.parametrize("light", [1, 40])
def test_trie_equals_brute_force(spark, light):
    rows = some_conversations()
    assert trie_of(spark, rows, light=light) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert trie_of(spark, []) == []
    assert trie_of(spark, [(None, 1, "user", "x", 1, "")]) == []


def test_queue_spills_sorted_runs():
    rng = np.random.default_rng(1)
    queue, sums = Queue(64), Counter()
    for _ in range(40):
        messages = np.zeros(30, MESSAGE)
        messages["k1"], messages["k2"] = rng.integers(-50, 50, 30), rng.integers(0, 3, 30)
        messages["leaves"] = rng.integers(1, 9, 30)
        for m in messages:
            sums[int(m["k1"]), int(m["k2"])] += int(m["leaves"])
        queue.push(messages)
    assert queue.files
    queue.ready()
    got = Counter()
    for k1 in range(-50, 50, 7):
        part = queue.take(k1, 1)
        assert all((m["k1"], m["k2"]) <= (k1, 1) for m in part)
        for m in part:
            got[int(m["k1"]), int(m["k2"])] += int(m["leaves"])
    for m in queue.take(99, 0):
        got[int(m["k1"]), int(m["k2"])] += int(m["leaves"])
    assert queue.empty() and got == sums


# The audit


def brute_audit(rows, least=3, top=200):
    docs = [((t or ""), (lang or ""), (s or "")) for _, t, lang, s, *_ in rows]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t)) for t, _, _ in docs]
    often, counts, groups = Counter(), Counter(), sorted({(lang, s) for _, lang, s in docs})
    for (_, lang, s), words in zip(docs, terms):
        often.update((lang, w) for w in set(words))
        counts.update((lang, s, w) for w in words)
    kept = defaultdict(list)
    for (lang, w), n in often.items():
        if n >= least:
            kept[lang].append(w)

    def share(count, total, v):
        return 1 + 10**9 * (count + 1) // (total + v)

    out = []
    for lang, s in groups:
        words, peers = kept[lang], [x for y, x in groups if y == lang]
        totals = {x: sum(counts[lang, x, w] for w in words) for x in peers}
        p = {x: [share(counts[lang, x, w], totals[x], len(words)) for w in words] for x in peers}
        all_counts = [sum(counts[lang, x, w] for x in peers) for w in words]
        whole = [share(n, sum(totals.values()), len(words)) for n in all_counts]
        pairs = [(-sum((a - b) ** 2 // b for a, b in zip(p[s], p[x])), x.encode()) for x in peers if x != s]
        best = [(-((a - b) ** 2 // b), w.encode()) for a, b, w in zip(p[s], whole, words)
                if counts[lang, s, w] and a > b]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(best)[:top])):
            out += [(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(found, 1)]
    return sorted(out)


DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, part STRING, value LONG"


def some_documents():
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in "abcXÉ漢" for b in "lmnopq"] + ["y" * 300, "z" * 5000]
    rows = [(None, None, None, None), (1, "", "en", "s"), (2, "x", "", ""), (3, "1 2 3", "xx", "only"),
            (4, "a b", "de", "p"), (5, None, "de", "q")]
    for i in range(10, 130):
        text = rng.choice([" ", "-", "1"]).join(rng.choices(vocabulary, k=rng.randint(1, 40)))
        rows.append((i % 50, text, rng.choice(["en", "EN", None]), rng.choice(["hot"] * 3 + ["s", "t", None])))
    rows += [rows[-1]] * 3
    return [(*r, "clash", 1) for r in rows]


@pytest.mark.parametrize("keys, wave, cells", [(1 << 15, 64 << 20, 1 << 16), (5, 1, 12)])
def test_audit_equals_brute_force(spark, monkeypatch, keys, wave, cells):
    for name, value in (("KEYS", keys), ("WAVE", wave), ("CELLS", cells)):
        monkeypatch.setattr(audit, name, value)
    rows = some_documents()
    top = 200 if keys > 5 else 3
    found = source_divergence(spark.createDataFrame(rows, DOCS), top=top)
    assert sorted(map(tuple, found.collect())) == brute_audit(rows, top=top)


def test_audit_of_nothing(spark):
    assert source_divergence(spark.createDataFrame([], DOCS)).collect() == []


def test_perfect_hash_has_a_slot_for_every_term():
    terms = pa.array([f"term{i}" for i in range(5000)] + ["x" * 1000])
    made = build(terms)
    order = made.pop("order")
    table = Table(**made)
    slots = table.find(stored(terms), hashes(stored(terms)))
    assert sorted(slots) == list(range(5001)) and (order[slots] == np.arange(5001)).all()
    other = pa.array([f"other{i}" for i in range(5000)])
    assert (table.find(other, hashes(other)) == -1).all()


def test_shares_are_exact():
    counts = np.array([0, 1, 10**15, 8 * 10**15])
    total = 9 * 10**15
    assert audit.shares(counts, total).tolist() == [1 + 10**9 * (int(c) + 1) // total for c in counts]


# Scores


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or "")) + ["</s>"]


def brute_base(rows):
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, *_ in rows}
    counts = Counter()
    for i, text, *_ in rows:
        if not held[i]:
            counts.update(tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text, *_ in rows:
        t = tokens_of(text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
        out.append((-1 if i is None else i, held[i], len(t), sum(counts[w] > 0 for w in t), n, round(base, 6)))
    return sorted(out)


def scores(docs):
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return scored_texts(docs, F.crc32(number.cast("binary")) % 7 == 2)


def text_rows():
    rng = random.Random(8)
    rows = [(None, "a b"), (None, None), (1, ""), (2, "  \t\n"), (3, "x" * 70_000), (9, "É é A a")]
    rows += [(i, " ".join(rng.choices(["the", "of", "cat", f"w{i}"], k=rng.randint(1, 60)))) for i in range(10, 90)]
    rows += [(500, "hot pair " * 30_000)] + [rows[-1]] * 2
    return [(*r, "en", "s", "clash", 7) for r in rows]


@pytest.mark.parametrize("parcel", [16 << 20, 300])
def test_scores_equal_brute_force(spark, monkeypatch, parcel):
    monkeypatch.setattr(py, "PARCEL", parcel)
    rows = text_rows()
    found = scores(spark.createDataFrame(rows, DOCS)).collect()
    got = sorted((-1 if r[0] is None else r[0], *r[1:5], round(r.base_score, 6)) for r in found)
    assert got == brute_base(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    rows = text_rows()
    one = scores(spark.createDataFrame(rows, DOCS)).collect()
    monkeypatch.setattr(py, "PARCEL", 2000)
    other = scores(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    both = [sorted((r.n_tokens, r.doc_id or -1, round(r.score, 3)) for r in x) for x in (one, other)]
    for a, b in zip(*both, strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 2e-4 * a[0] + 1e-3


def test_probabilities_sum_to_one(spark):
    """Of every token after a context, an unknown one included: texts of one token and the end."""
    rng = random.Random(2)
    learnt = [(i, " ".join(rng.choices("abcde", k=30))) for i in range(100) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(10_000, 11_000) if zlib.crc32(str(i).encode()) % 7 == 2]
    probes = [(i, f"a {w}") for i, w in zip(held, [*"abcde", "unknown"])] + [(held[9], "a"), (held[10], "")]
    rows = [(*r, "en", "s", "", 0) for r in learnt + probes]
    found = {r.doc_id: r.score for r in scores(spark.createDataFrame(rows, DOCS)).collect()}
    texts = {t: 10 ** found[i] for i, t in probes}
    after = scores(spark.createDataFrame([(*r, "en", "s", "", 0) for r in learnt + [(held[i], f"{w}") for i, w in enumerate([*"abcde", "unknown"])] + [(held[9], "")]], DOCS)).collect()
    first = {r.doc_id: r.score for r in after}
    # P(w) * P(end | w) for each w, and P(end): they cannot exceed one together
    assert sum(10**s for i, s in first.items() if i >= 10_000) < 1
    assert all(0 < p < 1 for p in texts.values())


def test_scores_beat_the_base_on_a_test_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = q.op12_lm_scoring(spark, sf_dir).collect()
    got = sorted((r[0], *r[1:5], round(r.base_score, 6)) for r in found)
    assert [g[:5] for g in got] == [b[:5] for b in brute_base(rows)]
    assert all(abs(g[5] - b[5]) < 1e-4 for g, b in zip(got, brute_base(rows)))
    held = [r for r in found if r.held_out]
    n = sum(r.n_tokens for r in held)
    perplexity, base = (10 ** (-sum(getattr(r, c) for r in held) / n) for c in ("score", "base_score"))
    assert perplexity < 0.7 * base


def test_seating_follows_the_restaurant():
    """Tables of a dish, against customers that sit down one after the other."""
    rng = np.random.default_rng(0)
    room, n, trials = Room(0.7, 1.0), 40, 4000
    for share, others in ((0.5, 3), (0.01, 100)):
        slow = []
        for _ in range(trials):
            t = 1
            for seats in range(1, n):
                opens = (room.strength + room.discount * (others + t)) * share
                t += rng.random() < opens / (seats - room.discount * t + opens)
            slow.append(t)
        keys = rng.integers(0, 1 << 63, trials).astype(np.uint64)
        fast = seated(np.full(trials, n), np.full(trials, others), np.full(trials, share), room, keys, 1)
        error = 5 * np.std(slow) / math.sqrt(trials)
        assert abs(np.mean(fast) - np.mean(slow)) < error
        assert abs(np.std(fast) - np.std(slow)) < 0.1 * np.std(slow) + 0.02


def test_mail_travels_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(py, "POSTED", 4000)
    draw = np.random.default_rng(0)
    rows = [
        {"at": i, "kind": py.SENT, "x": draw.integers(0, 9, 300), "gaps": draw.integers(0, 9, 20).astype(np.int32)}
        for i in range(50)
    ]
    rows[7]["x"] = draw.integers(0, 9, 2000)  # longer than a batch
    batches = list(py._batches(rows))
    assert len(batches) > 25
    assert sum(b.nbytes > 6000 for b in batches) == 1
    got = pa.Table.from_batches(batches)
    assert got.column("at").to_pylist() == list(range(50))
    for row, x, gaps in zip(rows, got.column("x"), got.column("gaps"), strict=True):
        assert x.as_py() == row["x"].tolist() and gaps.as_py() == row["gaps"].tolist()
    assert py._mail([]).num_rows == 0
