"""Quality rules with verdicts on whole hosts, in DataFrame functions only.

Each document is measured and tried by four rules: too few words, too much repetition, too many symbols, too many repeated
lines. Spark adds the failures up by host. A rate of few documents says little, so each host's rate is shrunk towards
the rate of all hosts by a beta prior, whose weight comes from how much the rates differ beyond chance. A host whose shrunk
rate of any rule passes ``max_host_rate`` is bad, and its verdict goes back to its documents.

A document is kept if it fails neither of the first two rules and its host is not bad. Null texts are empty, documents
without a host are of one host, repeated rows count and return each, and an empty table has no hosts. Columns of the
documents may have any names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.tables import written

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
MAX_SYMBOL_PERCENT, MAX_LINE_PERCENT = 10, 30
RULES = ("few_words", "repeated_words", "many_symbols", "repeated_lines")
MAX_HOST_RATE = 0.5
#: The prior weighs as much as this many documents at most, and at least as much as one.
MAX_PRIOR = 10_000.0


def _free(df: DataFrame, name: str) -> str:
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _replaced(text: Column, letters: str, by: str) -> Column:
    """Each of ``letters`` replaced in turn, which is a plain search where a letter does not occur."""
    return reduce(lambda a, b: F.replace(a, F.lit(b), F.lit(by)), letters, text)


def measured(docs: DataFrame, text: str, into: str) -> DataFrame:
    """``docs`` with a struct column ``into``: counts of the text and which rules it fails.

    Repeated windows are told by a 64-bit hash within a text. Each step is a column of its own, so that nothing is
    evaluated again for every element; the sort runs on texts with a repeated window only.
    """
    names = ["t", "w", "l", "h", "s", "d", "p"]
    t, w, l, h, s, d, p = (_free(docs, f"_{into}_{x}") for x in names)  # noqa: E741
    keep = docs.columns
    c = F.col
    df = docs.withColumn(t, F.coalesce(c(text), F.lit("")))
    df = df.withColumn(w, F.array_remove(F.split(_replaced(c(t), BLANKS[1:], " "), " "), ""))
    df = df.withColumn(l, F.filter(F.split(c(t), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    df = df.withColumn(h, F.transform(c(w), lambda x: F.xxhash64(x)))
    n = F.size(w)
    # Shifted copies side by side: a window is one row of them.
    shifted = (F.slice(c(h), k + 1, F.greatest(n, F.lit(1))).alias(f"w{k}") for k in range(WINDOW))
    rows = F.slice(F.arrays_zip(*shifted), 1, F.greatest(n - (WINDOW - 1), F.lit(0)))
    df = df.withColumn(s, F.transform(rows, lambda x: F.xxhash64(x)))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    pairs = F.transform(c(s), lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    df = df.withColumn(d, F.when(F.size(F.array_distinct(c(s))) < F.size(s), F.sort_array(pairs)).otherwise(none))

    def repeats(x: Column, i: Column) -> Column:
        other = lambda k: F.get(c(d), k)["h"] == x["h"]
        return F.coalesce(other(i - 1), F.lit(False)) | F.coalesce(other(i + 1), F.lit(False))

    df = df.withColumn(p, F.sort_array(F.transform(F.filter(c(d), repeats), lambda x: x["i"])))
    # A repeated window covers its words up to the start of the next one.
    steps = F.transform(c(p), lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(c(p), i + 1) - x, F.lit(WINDOW))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    letters = F.length(F.array_join(c(w), ""))
    symbols = F.length(t) - F.length(_replaced(c(t), SYMBOLS, ""))
    counts = F.struct(
        n.cast("long").alias("n_words"), letters.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
        (F.size(l) - F.size(F.array_distinct(c(l)))).cast("long").alias("n_dup_lines"), covered.alias("n_repeat_words"),
        F.size(l).cast("long").alias("n_lines"),
    )
    df = df.select(*keep, counts.alias(into))
    m = lambda x: c(into)[x]
    failures = (
        m("n_words") < MIN_WORDS,
        100 * m("n_repeat_words") > MAX_REPEATED_PERCENT * m("n_words"),
        100 * m("n_symbols") > MAX_SYMBOL_PERCENT * m("word_chars"),
        100 * m("n_dup_lines") > MAX_LINE_PERCENT * m("n_lines"),
    )
    return df.withColumn(into, F.struct(f"{into}.*", *(x.alias(name) for x, name in zip(failures, RULES, strict=True))))


def host_rates(measures: DataFrame, host: Column, into: str, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``(host, n, <rule> shrunk rates, bad)`` of measured documents."""
    fails = [F.sum(F.col(into)[x].cast("long")).alias(x) for x in RULES]
    hosts = written(measures.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("n"), *fails), "rules-hosts")
    sums = [F.sum("n").alias("n"), F.count(F.lit(1)).alias("hosts")]
    for x in RULES:
        sums += [F.sum(x).alias(x), F.sum(F.col(x) * F.col(x) / F.col("n")).alias(f"{x}_squares")]
    total = hosts.agg(*sums).first()  # one row of sums
    rates = []
    for x in RULES:
        mean, weight = beta_prior(total["n"] or 0, total["hosts"], total[x] or 0, total[f"{x}_squares"] or 0.0)
        rates.append(((F.col(x) + mean * weight) / (F.col("n") + weight)).alias(x))
    hosts = hosts.select("host", "n", *rates)
    return hosts.withColumn("bad", reduce(lambda a, b: a | b, (F.col(x) > max_host_rate for x in RULES)))


def beta_prior(documents: int, hosts: int, failed: int, squares: float) -> tuple[float, float]:
    """Mean and weight (a + b) of a beta prior, fitted by moments to the rates of hosts, weighted by their documents.

    ``squares`` is the sum of the squared failures of each host divided by its documents. Where the rates
    differ no more than chance would have it, the prior has its largest weight.
    """
    if not documents:
        return 0.0, 1.0
    mean = failed / documents
    chance = mean * (1 - mean)
    spread = squares / documents - mean * mean
    beyond = spread - chance * hosts / documents
    weight = (chance - spread) / beyond if beyond > 0 else MAX_PRIOR
    return mean, min(max(weight, 1.0), MAX_PRIOR)


def judged(docs: DataFrame, text: str = "text", host: str = "source", into: str = "rules", columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or the ``columns`` of it) with a struct column ``into``: counts, rules, ``base_failed`` and ``kept``."""
    into = _free(docs, into)
    name = _free(docs, f"{into}_host")
    keep = docs.columns if columns is None else columns
    rows = measured(docs.withColumn(name, docs[host].cast("string")), text, into).select(*keep, name, into)
    rows = written(rows, "rules-measured")  # read twice, measured once
    hosts = host_rates(rows, F.col(name), into).select(F.col("host").alias(f"{name}_key"), F.col("bad").alias(f"{name}_bad"))
    hosts = written(hosts, "rules-verdicts")  # of known size: broadcast if small, else a large host is split
    joined = rows.join(hosts, F.col(name).eqNullSafe(F.col(f"{name}_key")), "left")
    base = F.col(into)["few_words"] | F.col(into)["repeated_words"]
    kept = ~base & ~F.coalesce(F.col(f"{name}_bad"), F.lit(False))
    return joined.select(*keep, F.struct(f"{into}.*", base.alias("base_failed"), kept.alias("kept")).alias(into))


def well_formed(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that are kept, with their columns."""
    into = _free(docs, "rules")
    return judged(docs, text, host, into).where(F.col(into)["kept"]).select(*docs.columns)
