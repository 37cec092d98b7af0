"""Toxicity scores by weak supervision: voters, a label model over them, a linear classifier.

1. Lexicons. Words and beginnings of words that toxic rows of a bounded sample of labelled rows
   have far more often than clean ones (``SAMPLE`` rows of each label at most, those of least
   hash; only labels of rows that are not held out) become lexicons, by kind of term and by half.
2. One pass over all texts counts the terms of each lexicon and a few patterns.
3. Voters fire on such counts. A generative model of how they fire together, given an unknown
   label, is fitted by expectation maximisation on the counts of all vote patterns of the whole
   corpus: the share of toxic documents, each voter's rate of firing on both labels (its
   accuracy), and the correlation of voters within a label. A voter's say is divided by how much
   of it its correlated fellows repeat. Where labelled rows have a pattern, their share joins in.
4. A logistic regression from the counts to the model's posterior labels, fitted on the sampled
   rows, scores every document.

Labels, language, source and id never enter a score. Null and empty texts have no counts and get
the score of such texts. Every row gives a result row, repeated ones too. A null id counts as
held out. Without any label of both kinds only the built-in list votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.shared import Rolling, chunks, staged, utf8

#: Labelled rows of each label that lexicons and the classifier are learnt from, at most.
SAMPLE = 6_000
#: Terms in all lexicons, at most.
TERMS = 6_000
FOLDS = 5
#: Labelled rows of a pattern of votes that the voters' own opinion is worth.
PRIOR = 4.0

# Fixed list: plain insults in the languages of common corpora.
INSULTS = (
    "idiot idiots stupid moron morons dumb loser losers pathetic worthless scum trash disgusting "
    "clown fool jerk garbage imbecile dummkopf arschloch abschaum vollidiot widerlich connard "
    "salaud imbécile ordure dégoûtant estúpido estúpida imbécil basura asqueroso inútil"
).split()

KINDS = (0, 4, 5, 6, 7)  # whole words, and beginnings of so many bytes
LEXICONS = 2 * len(KINDS) + 1
#: Counts of each document: words, different terms of each lexicon, all hits, patterns.
COUNTS = ["words", *[f"lexicon_{i}" for i in range(LEXICONS)], "hits", "masked", "shouted", "called"]

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(doc_id: str = "doc_id") -> Column:
    crc = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0))
    return crc % FOLDS == 0


def _terms(data: np.ndarray, offsets: np.ndarray):
    """(terms, text, kind) for each word and each beginning of one, and the words' places."""
    low = _LOWER[data]
    letter = np.zeros(len(data) + 2, bool)
    letter[1:-1] = _LETTER[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    inner = letter[1:-1]
    starts = np.flatnonzero(inner & (~letter[:-2] | cut[:-1]))
    ends = np.flatnonzero(inner & (~letter[2:] | cut[1:])) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    rolling = Rolling(low)
    terms = []
    for k, width in enumerate(KINDS):
        stop = ends if not width else np.minimum(starts + width, ends)
        long = ends - starts >= max(width + 1, 3) if width else ends - starts >= 3
        terms.append((rolling.ranges(starts, stop) ^ np.uint64(k), long))
    return terms, row, starts, ends


def _parts(batch: pa.RecordBatch):
    data, offsets = utf8(batch.column("text"))
    for a, b in chunks(offsets):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and clean texts of each batch have a term."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for a, b, data, offsets in _parts(batch):
            found, row, _, _ = _terms(data, offsets)
            for k, (terms, usable) in enumerate(found):
                both = np.empty(int(usable.sum()), [("term", "u8"), ("row", "i8")])
                both["term"], both["row"] = terms[usable], row[usable]
                both = np.unique(both)
                names, at = np.unique(both["term"], return_inverse=True)
                bad = np.bincount(at, toxic[a:b][both["row"]] == 1, len(names))
                total = np.bincount(at, minlength=len(names))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names.view(np.int64)),
                        pa.array(np.full(len(names), k, np.int32)),
                        pa.array(bad.astype(np.int64)),
                        pa.array(total - bad.astype(np.int64)),
                    ],
                    ["term", "kind", "bad", "good"],
                )


def _counts(lexicon: np.ndarray, of: np.ndarray, called: np.ndarray):
    """``lexicon``: sorted terms; ``of``: the lexicon of each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in _parts(batch):
                n = b - a
                found, row, starts, ends = _terms(data, offsets)
                out = np.zeros((len(COUNTS), n))
                out[0] = np.bincount(row, minlength=n)
                spoken = np.isin(found[0][0], called)
                hit_words = np.zeros(len(row), bool)
                for terms, usable in found:
                    at = np.minimum(np.searchsorted(lexicon, terms), max(len(lexicon) - 1, 0))
                    hit = usable & (lexicon[at] == terms) if len(lexicon) else np.zeros(0, bool)
                    if hit.any():
                        hit_words |= hit
                        pair = np.unique(row[hit] * len(lexicon) + at[hit])
                        where = of[pair % len(lexicon)] * n + pair // len(lexicon)
                        out[1 : 1 + LEXICONS] += np.bincount(
                            where, minlength=LEXICONS * n
                        ).reshape(LEXICONS, n)
                out[1 + LEXICONS] = np.bincount(row[hit_words], minlength=n)
                after = data[np.minimum(ends, max(len(data) - 1, 0))]
                masked = np.isin(after, np.frombuffer(b"*#$%&@", np.uint8)) & (ends < len(data))
                out[2 + LEXICONS] = np.bincount(row[masked], minlength=n)
                first = data[starts]
                second = data[np.minimum(starts + 1, max(len(data) - 1, 0))]
                loud = (first >= 65) & (first < 91) & (second >= 65) & (second < 91)
                out[3 + LEXICONS] = np.bincount(row[loud], minlength=n)
                out[4 + LEXICONS] = np.bincount(row[spoken], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, n),
                        batch.column("version").slice(a, n),
                        *[pa.array(x.astype(np.float32)) for x in out],
                    ],
                    ["doc_id", "version", *COUNTS],
                )

    return count


def _hash_words(words: list[str]) -> np.ndarray:
    text = [w.encode() for w in words]
    data = np.frombuffer(b" ".join(text), np.uint8)
    terms, _, _, _ = _terms(data, np.array([0, len(data)]))
    return terms[0][0]


def _lexicons(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted terms and the lexicon of each; the last lexicon is the built-in list."""
    counted = (
        sample.select("text", "toxic")
        .mapInArrow(_frequencies, "term long, kind int, bad long, good long")
        .groupBy("term", "kind")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    )
    total = sample.groupBy().agg(
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad"), F.count("*").alias("rows")
    ).first()
    bad, good = total["bad"], total["rows"] - total["bad"]
    builtin = np.unique(_hash_words(INSULTS))
    terms, of = [builtin], [np.full(len(builtin), LEXICONS - 1)]
    if bad and good:
        odds = F.log(
            (F.col("bad") + 0.5) * (good + 1) / ((F.col("good") + 0.5) * (bad + 1))
        )
        least = max(5, round(0.01 * bad))
        rows = (
            counted.where(F.col("bad") >= least)
            .withColumn("odds", odds)
            .where("odds > 3")
            .orderBy(F.desc("odds"), F.desc("bad"), "term")
            .limit(TERMS)
            .collect()
        )
        mined = np.array([r["term"] for r in rows], np.int64).view(np.uint64)
        kind = np.array([r["kind"] for r in rows], np.int64)
        half = (mined >> np.uint64(40)).astype(np.int64) % 2
        terms.append(mined)
        of.append(2 * kind + half)
    terms, of = np.concatenate(terms), np.concatenate(of)
    # a mined term that is built in too stays in the built-in list
    terms, first = np.unique(terms, return_index=True)
    return terms, of[first]


# Voters


def _voters() -> list[Column]:
    hits, words = F.col("hits"), F.greatest(F.col("words"), F.lit(1.0))
    return [
        *[F.col(f"lexicon_{i}") > 0 for i in range(LEXICONS)],
        hits >= 2,
        hits / words > 0.01,
        F.col("masked") / words > 0.1,
        F.col("shouted") / words > 0.05,
        (F.col("called") > 0) & (hits > 0),
    ]


def votes() -> Column:
    """All votes of a document as one number, a bit for each voter."""
    return sum(
        (F.when(v, F.lit(1 << i)).otherwise(F.lit(0)) for i, v in enumerate(_voters())), F.lit(0)
    ).cast("long")


@dataclass
class LabelModel:
    share: float
    rates: np.ndarray  # of firing, by label and voter
    say: np.ndarray  # weight of each voter after its correlations
    known: dict[int, tuple[float, float]]  # labelled rows of a pattern, clean and toxic

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Labelled rows of a pattern count, and the voters as ``PRIOR`` rows more."""
        clean, toxic = np.array(
            [self.known.get(p, (0.0, 0.0)) for p in patterns.tolist()], float
        ).reshape(-1, 2).T
        return (toxic + PRIOR * self.of_voters(patterns)) / (clean + toxic + PRIOR)

    def of_voters(self, patterns: np.ndarray) -> np.ndarray:
        fires = (patterns[:, None] >> np.arange(self.rates.shape[1])) & 1
        one = np.log(self.rates)[:, None, :]
        none = np.log1p(-self.rates)[:, None, :]
        score = ((fires * one + (1 - fires) * none) * self.say).sum(2)
        odds = np.log(self.share) - np.log1p(-self.share) + score[1] - score[0]
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit_label_model(
    patterns: np.ndarray, label: np.ndarray, count: np.ndarray, steps: int = 30
) -> LabelModel:
    """From counts of vote patterns; ``label`` is 0 or 1 where known, else -1."""
    n = len(_voters())
    fires = ((patterns[:, None] >> np.arange(n)) & 1).astype(float)
    known = label >= 0
    rows: dict[int, tuple[float, float]] = {}
    for p, y, c in zip(patterns[known].tolist(), label[known], count[known], strict=True):
        clean, toxic = rows.get(p, (0.0, 0.0))
        rows[p] = (clean + c * (y == 0), toxic + c * (y == 1))
    bad = np.where(known, label, np.where(fires[:, :LEXICONS].any(1), 0.8, 0.02))
    say = np.ones(n)
    for _ in range(steps):
        weight = np.stack([(1 - bad) * count, bad * count])
        mass = weight.sum(1)
        rates = np.clip((weight @ fires + 0.5) / (mass[:, None] + 1), 1e-4, 1 - 1e-4)
        share = float(np.clip(mass[1] / mass.sum(), 1e-4, 0.5))
        repeated = np.zeros(n)
        for y in (0, 1):
            off = (fires - rates[y]) / np.sqrt(rates[y] * (1 - rates[y]))
            within = (off * weight[y][:, None]).T @ off / max(mass[y], 1)
            np.fill_diagonal(within, 0)
            repeated = np.maximum(repeated, np.minimum(within**2, 1).sum(1))
        say = 1 / (1 + repeated)
        model = LabelModel(share, rates, say, rows)
        bad = np.where(known, label, model.posterior(patterns))
    return model


# Classifier


def _features() -> list[Column]:
    words = F.greatest(F.col("words"), F.lit(1.0))
    lexicons = [F.least(F.col(f"lexicon_{i}"), F.lit(4.0)) / 4 for i in range(LEXICONS)]
    hits = F.col("hits")
    return [
        *lexicons,
        F.least(hits, F.lit(8.0)) / 8,
        F.least(hits / words * 20, F.lit(1.0)),
        (hits >= 2).cast("double"),
        F.least(F.col("masked") / words, F.lit(1.0)),
        F.least(F.col("called") * hits, F.lit(4.0)) / 4,
    ]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3):
    """Weights of a logistic regression, the last one its constant, by Newton's steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = penalty * weight.sum() * np.eye(len(w))
    ridge[-1, -1] *= 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge @ w
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, version, held_out, score, predicted) of each row of ``docs``.

    ``version`` is ``xxhash64`` of the text.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(body).alias("version"), body.alias("text")
    )
    learnt = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    by_hash = F.xxhash64("doc_id", F.lit(4))
    chosen = staged(
        learnt.where("toxic = 1").orderBy(by_hash).limit(SAMPLE)
        .unionAll(learnt.where("toxic = 0").orderBy(by_hash).limit(SAMPLE)),
        "labelled",
    )
    sample = rows.join(F.broadcast(chosen), "doc_id")  # SAMPLE bounds it
    lexicon, of = _lexicons(sample)
    called = _hash_words(["you", "your", "yours", "du", "dich", "dein", "vous", "toi", "usted"])
    schema = "doc_id long, version long, " + ", ".join(f"{c} float" for c in COUNTS)
    counts = staged(rows.mapInArrow(_counts(lexicon, of, np.unique(called)), schema), "counts")

    # one row for each pattern of votes, not for each document
    patterns = (
        counts.withColumn("votes", votes())
        .join(learnt, "doc_id", "left")
        .groupBy("votes", F.coalesce("toxic", F.lit(-1)).alias("label"))
        .count()
        .toPandas()
    )
    if not len(patterns):
        return counts.select(
            "doc_id",
            "version",
            held_out().alias("held_out"),
            F.lit(0.0).alias("score"),
            F.lit(0).alias("predicted"),
        )
    model = fit_label_model(*(patterns[c].to_numpy() for c in ("votes", "label", "count")))

    picked = counts.join(F.broadcast(chosen), "doc_id")
    fitted = picked.select(
        votes().alias("votes"), *[f.alias(f"f{i}") for i, f in enumerate(_features())]
    ).limit(4 * SAMPLE).toPandas()
    if len(fitted):
        target = model.posterior(fitted["votes"].to_numpy())
        x = fitted[[c for c in fitted if c != "votes"]].to_numpy(float)
        # the sample holds labels in other shares than the corpus
        weight = np.where(target >= 0.5, model.share / max(target.mean(), 1e-3),
                          (1 - model.share) / max(1 - target.mean(), 1e-3))
        w = _logistic(x, target, weight)
    else:
        w = np.array([*[4.0] * (LEXICONS + 5), -3.0])
    linear = sum((f * float(c) for f, c in zip(_features(), w[:-1], strict=True)), F.lit(float(w[-1])))
    score = 1 / (1 + F.exp(-linear))
    return counts.select(
        "doc_id",
        "version",
        held_out().alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
    )
