"""Quality rules judged by host as well as by document.

Rules fail single documents. Failures are counted by host (``source``), each host's
rate is shrunk towards that of all hosts by a beta prior fitted to their rates, and a
host above ``MAX_RATE`` loses all its documents. Everything is built from SQL functions;
a host with a third of the rows is counted in the map tasks and joined as a few numbers.

The prior: with mean rate m over documents and variance v of the rates over hosts,
its strength is m(1-m)/v - 1, between ``LEAST_PRIOR`` and ``MOST_PRIOR`` documents.

Edge cases: a NULL or empty text has no words and fails; documents without a host are
judged by themselves; repeated rows count each. An empty table gives no rows. Only the
columns that are named are read. Windows of words are compared by 64-bit hashes
within one text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, cut

MAX_RATE = 0.5
LEAST_PRIOR, MOST_PRIOR = 2.0, 1000.0
WINDOW = 5


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


def repeated_words(found: Column, width: int = WINDOW) -> Column:
    """How many words lie in windows of ``width`` words that occur twice or more."""

    def windows(hashed: Column) -> Column:
        return F.when(
            F.size(hashed) > width,
            F.transform(
                F.sequence(F.lit(0), F.size(hashed) - width),
                lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(width)]),
            ),
        )

    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            own = lambda k: F.get(p, k)["h"]
            twice = F.filter(
                F.sequence(F.lit(0), F.size(p) - 1),
                lambda k: own(k).eqNullSafe(own(k + 1)) | own(k).eqNullSafe(own(k - 1)),
            )
            return F.sort_array(F.transform(twice, lambda k: F.get(p, k)["i"]))

        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        step = lambda a, i: F.struct(
            (i + width).alias("end"),
            (a["n"] + i + width - F.greatest(i, a["end"])).cast("long").alias("n"),
        )
        return F.aggregate(_let(pairs, places), start, step, lambda a: a["n"])

    hashed = F.transform(found, lambda w: F.xxhash64(w))
    count = lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w))
    return F.coalesce(_let(_let(hashed, windows), count), F.lit(0).cast("long"))


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id, host`` and what the rules look at."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    held = docs.select(F.col("doc_id"), F.col("source").alias("host"), "text", words(F.col("text")).alias("words"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.char_length(x)).alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        )

    repeats = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")
    symbols = F.coalesce(F.regexp_count("text", F.lit("[#*$%&|<>]")), F.lit(0)).cast("long")
    return held.select(
        "doc_id", "host", symbols.alias("n_symbols"), repeats.alias("n_dup_lines"), _let(F.col("words"), of_words).alias("w")
    ).select("doc_id", "host", "n_symbols", "n_dup_lines", "w.*")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def failed() -> Column:
    """A host's failures: the base rules, symbols for a tenth of the words, or words of
    a mean length outside 2 to 20."""
    symbols = 10 * F.col("n_symbols") > F.col("n_words")
    length = (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))
    return base_failed() | symbols | length


def host_rates(measured: DataFrame) -> DataFrame:
    """``host, n, n_failed, rate``: failures by host, shrunk."""
    hosts = (
        measured.where("host IS NOT NULL")
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(failed(), 1)).alias("n_failed"))
    )
    total = hosts.agg(
        (F.sum("n_failed") / F.sum("n")).alias("m"), F.var_pop(F.col("n_failed") / F.col("n")).alias("v")
    )
    spread = F.col("m") * (1 - F.col("m"))
    strength = F.when(F.col("v") > 0, F.least(F.greatest(spread / F.col("v") - 1, F.lit(LEAST_PRIOR)), F.lit(MOST_PRIOR))).otherwise(F.lit(MOST_PRIOR))
    prior = total.select("m", strength.alias("s"))
    row = prior.select(F.struct("m", "s"))
    return hosts.withColumn("prior", row.scalar()).select(
        "host",
        "n",
        "n_failed",
        ((F.col("n_failed") + F.col("prior.m") * F.col("prior.s")) / (F.col("n") + F.col("prior.s"))).alias("rate"),
    )


def judge(docs: DataFrame, *, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per row of ``docs``: the measures, ``base_failed``, ``host_rate`` and
    ``kept``."""
    measured = cut(measures(docs))
    rates = host_rates(measured).select("host", F.col("rate").alias("host_rate"))
    return measured.join(rates, "host", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        "host_rate",
        (~base_failed() & (F.coalesce("host_rate", F.lit(0.0)) <= max_rate)).alias("kept"),
    )
