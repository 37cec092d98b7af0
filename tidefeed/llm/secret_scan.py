"""Secret scans: fixed patterns, and a battery of randomness tests for strings without a pattern.

Base patterns give spans of kinds assign, access and hex. Besides, every run of 20 or more
characters of encodings is tested. The encoding is inferred from the characters (hex, base32,
base36, base62, base64) and gives an alphabet of m characters. Three statistics are about standard
normal for random strings: the chi-squared statistic of the characters' counts, the number of runs
above and below the alphabet's middle, and the correlation of neighbours. Their squares, summed
(of the first only an excess counts), say how unlike a random string it is.

How often do words look that random? Runs of letters without a digit are the null distribution. A
word's score grows with about the square of its length, so what is left of its logarithm beyond a
line in that of the length has one distribution for all lengths, and every null run of the corpus
serves every length, by the probability that it is a word and not a random string without a digit.
Its mean and spread start from those of a few typical words (``WORDS_N`` of them), and a logistic distribution of that mean and spread gives the p-value of a run: it does
not depend on how many null runs have that length, and there is one way from none to any number of
them. The Benjamini-Hochberg rule over all runs with letters, those without digits too, keeps the
share of false finds under ``FALSE_FINDS``. Besides, the battery itself must let the run pass as
random: its score is below what one of 1000 random strings exceeds. Runs that overlap a base span
are left to it.

Only DataFrame functions run here. Lengths, classes and scores are counted in a table of a few
thousand cells, whatever the corpus, and so the rule needs no sort of all runs.

Null and empty texts have no spans. Rows of one id and one text are one document for the tests; every
row gives a result row. Further columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefeed.llm.shared import keyed, real_id, staged

ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")
#: Values that are folded together, and characters of a block of text.
BLOCK, CHARS = 256, 4096
#: Least length of an assigned value.
VALUE = 8
FALSE_FINDS = 0.05
SCORES, SCORE_STEP = 400, 0.25
#: Classes of length for each doubling, and the last one.
LENGTHS, LAST_LENGTH = 4, 32
#: ln(1 + score) of typical words of n letters is about AT_0 + SLOPE * ln(n), give or take SPREAD:
#: 36 times the sum of squared letter frequencies, 0.065, gives z_chi = 0.16 n.
AT_0, SLOPE, SPREAD, WORDS_N = -3.0, 1.85, 0.6, 5
#: Share of words among runs without a digit, before their scores are known.
WORDS = 0.9
#: The chi-squared value of three degrees of freedom that one random string of 1000 exceeds.
BATTERY = 16.27

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, start: int, add: Callable[[Column, Column], Column]) -> Column:
    """For each of some ints, what those before it come to; then what all come to.

    A fold that appends to an array copies it every time. So blocks are folded alone, each from
    what the blocks before it come to: ``BLOCK`` copies for each value, and not all before it.
    """
    none = F.expr("CAST(array() AS array<int>)")

    def along(xs: Column, first: Column) -> Column:
        zero = F.struct(first.cast("int").alias("at"), none.alias("all"))
        done = F.aggregate(
            xs, zero,
            lambda d, x: F.struct(
                add(d["at"], x).cast("int").alias("at"), F.concat(d["all"], F.array(d["at"])).alias("all")
            ),
        )
        return done

    def blocked(xs: Column) -> Column:
        count = F.ceil(F.size(xs) / BLOCK).cast("int")
        cut = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
                          lambda i: F.slice(xs, (i - 1) * BLOCK + 1, BLOCK))
        return _let(cut, folded)

    def folded(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(start), lambda d, x: add(d, x).cast("int")))
        return _let(along(totals, F.lit(start)), lambda ends: F.concat(
            F.flatten(F.zip_with(blocks, ends["all"], lambda b, first: along(b, first)["all"])),
            F.array(ends["at"]),
        ))

    return _let(values, blocked)


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """(start, kind, end, value) of all matches, in characters; an empty array without a match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(matches: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
        # by turns the gap before a match and the match
        steps = F.flatten(F.zip_with(
            between, matches, lambda g, m: F.array(F.length(g), F.length(m))
        ))
        return _let(_running(steps, 0, lambda at, n: at + n), lambda at: F.transform(
            matches,
            lambda m, i: F.struct(
                F.get(at, 2 * i + 1).alias("start"), F.lit(kind).alias("kind"),
                F.get(at, 2 * i + 2).alias("end"), m.alias("value"),
            ),
        ))

    none = F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int,value:string>>)")
    return F.when(F.rlike(text, F.lit(pattern)), _let(found, placed)).otherwise(none)


def _apart(runs: Column, base: Column) -> Column:
    """The runs that overlap no span of ``base``; both are in order of their starts.

    A run overlaps one if, of the spans that start before its end, some ends after its start: a
    binary search, and the greatest end so far.
    """

    def kept(starts: Column, ends: Column) -> Column:
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(31))])

        def free(run: Column) -> Column:
            before = F.aggregate(
                steps, F.lit(0),
                lambda at, step: F.when(
                    (step <= F.size(starts) - at) & (F.get(starts, at + step - 1) < run["end"]), at + step
                ).otherwise(at),
            )
            return F.get(ends, before) <= run["start"]

        return F.filter(runs, free)

    starts = F.transform(base, lambda b: b["start"])
    ends = _running(F.transform(base, lambda b: b["end"]), 0, F.greatest)
    return _let(starts, lambda s: _let(ends, lambda e: kept(s, e)))


def _found(whole: DataFrame) -> DataFrame:
    """(id, version, base, runs): base spans by start and kind, and runs apart from them."""
    text = F.col("text")
    assigned = F.filter(
        _spans(text, ASSIGN, 0),
        lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= VALUE,
    )
    base = F.array_sort(F.concat(assigned, _spans(text, ACCESS, 1), _spans(text, HEX, 2)))
    both = whole.select("id", "version", base.alias("base"), _spans(text, RUN, 3).alias("runs"))
    return both.withColumn("runs", _apart(F.col("runs"), F.col("base")))


def _alphabet() -> Column:
    """The characters of the encoding that a run looks like; letters alone are base62 too."""
    s = F.col("value")
    chosen = [
        ("^[0-9a-f]+$", _DIGITS + "abcdef"),
        ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
        ("^[A-Z2-7]+=*$", _UPPER + "234567"),
        ("^[0-9a-z]+$", _DIGITS + _LOWER),
        ("^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER),
        ("[-_]", _UPPER + _LOWER + _DIGITS + "-_"),
    ]
    other = F.lit(_UPPER + _LOWER + _DIGITS + "+/")
    return reduce(
        lambda rest, c: F.when(F.rlike(s, F.lit(c[0])), F.lit(c[1])).otherwise(rest),
        reversed(chosen),
        other,
    )


def _scored(runs: DataFrame) -> DataFrame:
    """Adds ``score``: how unlike a random string of its encoding a run is."""
    one = runs.withColumn("alphabet", _alphabet()).withColumn("m", F.length("alphabet"))
    one = one.withColumn("chars", F.split(F.rtrim(F.col("value"), F.lit("=")), ""))
    one = one.withColumn("chars", F.filter("chars", lambda c: c != ""))
    one = one.withColumn("n", F.size("chars").cast("double")).where("n >= 8")
    one = one.withColumn(
        "ranks", F.expr("transform(chars, c -> cast(instr(alphabet, c) - (m + 1) / 2 AS double))")
    )
    squares = F.expr(
        "aggregate(array_distinct(chars), 0D, "
        "(sum, c) -> sum + pow(size(filter(chars, d -> d = c)), 2))"
    )
    chi = F.col("m") / F.col("n") * squares - F.col("n")
    one = one.withColumn(
        "z_chi", (chi - (F.col("m") - 1)) / F.sqrt(2 * (F.col("m") - 1) * (F.col("n") - 1) / F.col("n"))
    )
    one = one.withColumn(
        "sums",
        F.expr(
            "aggregate(ranks, named_struct('s', 0D, 'q', 0D, 'x', 0D, 'high', 0D, 'runs', 0D, "
            "'last', CAST(NULL AS double)), (a, r) -> named_struct("
            "'s', a.s + r, 'q', a.q + r * r, 'x', a.x + coalesce(a.last * r, 0D), "
            "'high', a.high + IF(r > 0, 1D, 0D), "
            "'runs', a.runs + IF(a.last IS NULL OR (a.last > 0) <> (r > 0), 1D, 0D), 'last', r))"
        ),
    )
    n, s = F.col("n"), F.col("sums")
    high, low = s["high"], F.col("n") - s["high"]
    mean = 2 * high * low / n + 1
    spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(0.01)))
    mu = s["s"] / n
    variance = s["q"] - n * mu * mu
    # of neighbours about the mean; the two end terms that it leaves out are below its noise
    serial = (s["x"] - (n - 1) * mu * mu) / F.greatest(variance, F.lit(1e-9)) * F.sqrt(n)
    one = one.withColumn("z_runs", (s["runs"] - mean) / spread).withColumn("z_serial", serial)
    z = F.greatest(F.col("z_chi"), F.lit(0.0))
    score = z * z + F.pow("z_runs", 2) + F.pow("z_serial", 2)
    # one character alone, or a repeated pair, is as far from random as can be
    return one.withColumn("score", F.coalesce(score, F.lit(1e6))).drop("chars", "ranks", "sums")


def _word(over: Column, score: Column) -> Column:
    """The probability that a run is a word: the density of words' scores against that of three
    degrees of freedom, both of ln(1 + score)."""
    scale = SPREAD * math.sqrt(3) / math.pi
    low = F.exp(-F.abs(over) / scale)
    as_word = WORDS * low / (scale * F.pow(1 + low, 2))
    as_random = (1 - WORDS) * (1 + score) * F.sqrt(score) * F.exp(-score / 2) / math.sqrt(2 * math.pi)
    # of a score beyond all measure both densities are nothing
    return F.when(score < SCORES * SCORE_STEP, as_word / (as_word + as_random)).otherwise(1.0)


def _random(found: DataFrame) -> DataFrame:
    """(id, version, random): the runs that the battery and the rule keep."""
    runs = (
        found.dropDuplicates(["id", "version"])
        .where("size(runs) > 0")
        .select("id", "version", F.explode("runs").alias("run"))
        .select("id", "version", "run", "run.value")
    )
    cell = F.least(F.floor(F.col("score") / SCORE_STEP), F.lit(SCORES - 1)).cast("int")
    length = F.least(F.floor(F.log2(F.col("n")) * LENGTHS), F.lit(LAST_LENGTH)).cast("int")
    over = F.log1p("score") - (AT_0 + SLOPE * F.log("n"))
    tested = staged(
        _scored(runs).select(
            "id",
            "version",
            "run",
            "score",
            cell.alias("cell"),
            length.alias("size"),
            # a run of one character alone says no more than a very unlikely word
            F.least(over, F.lit(5 * SPREAD)).alias("over"),
            _word(over, F.col("score")).alias("word"),
            F.rlike("value", F.lit("[0-9]")).alias("digits"),
            F.rlike("value", F.lit("[A-Za-z]")).alias("letters"),
        ),
        "runs",
    )
    over = F.col("over")
    null = tested.where("letters AND NOT digits").agg(
        *[
            F.coalesce(F.sum(F.col("word") * part), F.lit(0.0)).alias(name)
            for name, part in (("of", F.lit(1)), ("sum", over), ("squares", over * over))
        ]
    )
    mean = F.col("sum") / (F.col("of") + WORDS_N)
    variance = (F.col("squares") + WORDS_N * SPREAD**2) / (F.col("of") + WORDS_N) - mean * mean
    null = null.select(mean.alias("mean"), F.sqrt(variance).alias("spread"))
    # at most 33 * SCORES cells from here on; of each the corner that looks least random
    cells = tested.where("letters").groupBy("size", "cell").agg(F.count("*").alias("tried"))
    line = AT_0 + SLOPE * math.log(2) / LENGTHS * F.col("size") + F.col("mean")
    far = (F.log1p((F.col("cell") + 1) * SCORE_STEP) - line) / F.col("spread")
    cells = cells.crossJoin(null).withColumn("p", 1 / (1 + F.exp(-far * (math.pi / math.sqrt(3)))))
    alone = Window.partitionBy(F.lit(0))
    cells = cells.withColumn("better", F.sum("tried").over(alone.orderBy("p"))).withColumn(
        "all_tried", F.sum("tried").over(alone)
    )
    passes = F.col("p") <= FALSE_FINDS * F.col("better") / F.col("all_tried")
    cells = cells.withColumn("limit", F.max(F.when(passes, F.col("p"))).over(alone))
    passed = F.col("cell") * SCORE_STEP < BATTERY
    kept = cells.where(passed & (F.col("p") <= F.col("limit"))).select("size", "cell")
    return (
        tested.where("letters")
        .join(F.broadcast(kept), ["size", "cell"])
        .groupBy("id", "version")
        .agg(F.collect_list("run").alias("random"))
    )


def secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, version, base, spans): (start, kind, end, value) by start and kind.

    ``kind`` is the place in ``KINDS``. ``version`` is ``xxhash64`` of the text.
    """
    found = staged(_found(keyed(docs, text)), "secrets")
    spans = F.array_sort(F.concat("base", F.coalesce("random", F.expr("slice(base, 1, 0)"))))
    return found.join(_random(found), ["id", "version"], "left").select(
        real_id("id").alias("doc_id"), "version", "base", spans.alias("spans")
    )


def written(spans: str | Column) -> Column:
    """Spans as text, ``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                              s["end"].cast("string")),
    )
    return F.array_join(parts, ",")


def redacted(text: str | Column, spans: str | Column, mask: str = "[secret]") -> Column:
    """The text with each run of overlapping spans replaced."""
    text = F.col(text) if isinstance(text, str) else text
    spans = F.col(spans) if isinstance(spans, str) else spans
    # a long text's places are counted from its beginning, those of a block from the block's
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHARS}}}"), F.lit(0))

    def between(blocks: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / CHARS).cast("int")
        some = F.slice(blocks, first + 1, F.ceil(b / CHARS).cast("int") - first)
        return F.substr(F.array_join(some, ""), a - first * CHARS + 1, b - a)

    def masked(blocks: Column, ends: Column) -> Column:
        parts = F.transform(spans, lambda s, i: F.when(
            s["start"] >= F.get(ends, i),
            F.concat(F.when(s["start"] > F.get(ends, i), between(blocks, F.get(ends, i), s["start"]))
                     .otherwise(F.lit("")), F.lit(mask)),
        ).otherwise(F.lit("")))
        last = F.element_at(ends, -1)
        rest = F.when(F.length(text) > last, between(blocks, last, F.length(text))).otherwise(F.lit(""))
        return F.concat(F.array_join(parts, ""), rest)

    ends = _running(F.transform(spans, lambda s: s["end"]), 0, F.greatest)
    done = _let(cut, lambda blocks: _let(ends, lambda e: masked(blocks, e)))
    return F.when(F.size(spans) > 0, done).otherwise(text)
