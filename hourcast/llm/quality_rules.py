"""Quality rules as a bitmask ledger: every rule is evaluated once, policies and ablations are bit arithmetic.

``ledger`` measures each whole text once and stores the measurements and one bit per failed rule.
``apply_policy`` keeps what fails no rule of a versioned policy, and ``ablation`` counts in one aggregation
what each rule decides alone. All of it is built-in column expressions: no Python runs on the executors.

Words are ``[^\\x20\\x09-\\x0D]+``. ``n_dup_lines``: \\n-split lines with a word that equal an earlier line.
``n_repeat_words``: words in 3-word windows found twice or more in the text, the first one included.

Repeated windows are found per text by sorting (fingerprint, position) pairs, n log n in the words, so one
very long text costs no more than its length. Fingerprints have 64 bits and are compared within one text.

Defined cases: a null or wordless text has 0 for every measurement and fails ``min_words``. Repeated rows and
null ids give their own rows. Further columns are ignored by ``ledger`` unless named in ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word separators and counted symbols of the contract.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str  # SQL over the measurements


# Bits are never reused: a ledger written by an old version keeps its meaning.
RULES = (
    Rule(0, "min_words", "n_words < 50"),
    Rule(1, "repeat_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "dup_lines", "n_lines > 1 and 100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "short_words", "word_chars < 3 * n_words"),
    Rule(5, "long_words", "word_chars > 12 * n_words"),
    Rule(6, "max_words", "n_words > 100000"),
    Rule(7, "some_repeat_words", "100 * n_repeat_words > 30 * n_words"),
    # In five lines or fewer one repeated line alone is 20 % or more: the share says little, so this one asks for two at least.
    Rule(8, "several_dup_lines", "n_dup_lines > 1 and 100 * n_dup_lines > 30 * n_lines"),
)
BITS = {r.name: 1 << r.bit for r in RULES}
BASE = BITS["min_words"] | BITS["repeat_words"]
#: version -> rules that reject. 4 is 3 with the looser rule on lines.
POLICIES = {
    1: BASE,
    2: BASE | BITS["symbols"],
    3: BASE | BITS["symbols"] | BITS["dup_lines"] | BITS["short_words"] | BITS["long_words"],
    4: BASE | BITS["symbols"] | BITS["several_dup_lines"] | BITS["short_words"] | BITS["long_words"],
}
CURRENT = 3


def _once(c: Column) -> Column:
    """``c``, but no later filter moves below it: there each mention of ``c`` would make its arrays anew."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def _measure(df: DataFrame) -> DataFrame:
    """Adds the measurements of ``text``; arrays are made in steps, so that each is computed once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(F.length(trimmed) > 0, F.split(trimmed, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    df = df.select("*", _once(words).alias("_words"), lines.alias("_lines"),
                   (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
                   F.length(F.translate(text, SPACES, "")).cast("bigint").alias("word_chars"))
    n = F.size("_words")
    # (fingerprint, position) of each 3-word window, sorted: equal windows become neighbours.
    windows = F.when(n >= 4, F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i")))))
    df = df.select("*", n.cast("bigint").alias("n_words"), F.size("_lines").cast("bigint").alias("n_lines"),
                   (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
                   _once(windows).alias("_windows")).drop("_words", "_lines")
    fingerprint = lambda i: F.get("_windows", i)["h"]
    twice = F.sort_array(F.transform(F.filter(
        F.sequence(F.lit(0), F.size("_windows") - 1),
        lambda i: F.coalesce(fingerprint(i) == fingerprint(i - 1), F.lit(False)) | F.coalesce(fingerprint(i) == fingerprint(i + 1), F.lit(False))),
        lambda i: F.get("_windows", i)["i"]))
    df = df.select("*", _once(F.when(F.col("_windows").isNotNull(), twice)).alias("_twice")).drop("_windows")
    # Words under the windows: 3 each, less what the next window shares.
    covered = F.aggregate("_twice", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                          lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    return df.withColumn("n_repeat_words", _once(F.coalesce(covered, F.lit(0)).cast("bigint"))).drop("_twice")


def ledger(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the measurements and ``failed`` (bit r.bit set where rule r fails) for every row."""
    df = _measure(docs.select("doc_id", "text", *keep))
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("bigint") for r in RULES]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return df.select("doc_id", *keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
                     failed.alias("failed"))


def verdict(version: int = CURRENT) -> Column:
    return F.col("failed").bitwiseAND(F.lit(POLICIES[version])) == 0


def apply_policy(book: DataFrame, version: int = CURRENT) -> DataFrame:
    return book.withColumn("kept", verdict(version))


def ablation(book: DataFrame, version: int = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, that only it rejects, and what would be kept without it."""
    policy = POLICIES[version]
    used = [r for r in RULES if policy >> r.bit & 1]
    under = F.col("failed").bitwiseAND(F.lit(policy))
    sums = [F.count(F.lit(1)).alias("n"), F.count_if(under == 0).alias("kept")]
    for r in used:
        sums += [F.count_if(under.bitwiseAND(F.lit(1 << r.bit)) != 0).alias(f"f{r.bit}"), F.count_if(under == (1 << r.bit)).alias(f"o{r.bit}")]
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"f{r.bit}").alias("failing"), F.col(f"o{r.bit}").alias("only"),
                              (F.col("kept") + F.col(f"o{r.bit}")).alias("kept_without")) for r in used])
    return (book.agg(*sums).select(F.col("n").alias("documents"), F.col("kept"), F.explode(rows).alias("r"))
            .select("r.rule", "documents", "kept", "r.failing", "r.only", "r.kept_without"))


def report(docs: DataFrame, version: int = CURRENT) -> DataFrame:
    base_failed = F.col("failed").bitwiseAND(F.lit(BASE)) != 0
    return apply_policy(ledger(docs), version).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & F.col("kept")).alias("kept"), "failed")
