"""Quality rules (5): a rule bitmask ledger in DataFrame functions only.

:func:`measure` evaluates the measurements once per document; :func:`ledger`
turns every rule into one bit of ``failures``; a policy is a versioned set of
rules, applied as a mask (:func:`apply_policy`); :func:`ablations` computes the
effect of leaving out each rule of a policy from the ledger alone, by bitwise
tests inside one aggregate.

Everything stays within the document's own row: no shuffle, no Python.

Defined cases: a null text has no words (all measurements 0; it fails
``few_words``); empty tables give empty ledgers and one ablation row per rule
with zero counts; repeated rows each get a row; output columns replace input
columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import without

#: White space and symbol classes, window of the repetition rule.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW = 5

#: Bits of a position inside a (hash, position) pair of :func:`_repeat_words`.
_POS_BITS = 24

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_marks")

#: Rule name -> failure condition over the measurements; the position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbol_words": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "shouting": "10 * n_upper > 3 * word_chars",
    "exclamations": "10 * n_marks > n_words",
}

#: Policy version -> its rules.  A published version never changes.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbol_words", "duplicate_lines"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _neighbours(array: str, test) -> Column:
    """``test(left, right)`` over the neighbouring pairs of an array column."""
    a = F.col(array)
    return F.zip_with(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))),
                      F.slice(a, 2, F.size(a)), test)


def _repeat_words(df: DataFrame, width: int) -> DataFrame:
    """Adds ``_covered``: words inside ``width``-word windows that occur twice or
    more, from the columns ``_words`` and ``_hashes`` (hashes of the windows).

    Distinct window hashes tell most documents apart at once (none repeated).
    Else one sort of (hash, position) pairs packed into longs finds the windows
    whose hash repeats, and those alone are compared by their words.

    Each step is a column of its own and neighbours are paired by ``zip_with``:
    an array expression inside a lambda would be made anew per element.
    """
    low = (1 << _POS_BITS) - 1
    none = F.array().cast("array<bigint>")
    n = F.size("_hashes")
    repeated = F.size(F.array_distinct("_hashes")) < n
    df = df.select("*", F.when(repeated & (n <= low), F.sort_array(F.transform(
        "_hashes", lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))))
        .otherwise(none).alias("_packed"), (repeated & (n > low)).alias("_huge"))
    same = lambda a, b: F.when(
        F.shiftright(a, _POS_BITS) == F.shiftright(b, _POS_BITS),
        F.array(a.bitwiseAND(F.lit(low)), b.bitwiseAND(F.lit(low))))
    # beyond 2^24 windows positions do not fit: every window is compared by its words
    df = df.select("*", F.when(F.col("_huge"), F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))
                   .otherwise(F.array_distinct(F.flatten(F.array_compact(
                       _neighbours("_packed", same))))).alias("_at"))
    df = df.select("*", F.sort_array(F.transform("_at", lambda i: F.struct(
        F.array_join(F.slice("_words", (i + 1).cast("int"), width), " ").alias("k"),
        i.alias("i")))).alias("_keyed"))
    df = df.select("*", F.sort_array(F.array_distinct(F.flatten(F.array_compact(_neighbours(
        "_keyed", lambda a, b: F.when(a["k"] == b["k"], F.array(a["i"], b["i"]))))))).alias("_starts"))
    # a window's own part: up to the next start, the last one in full
    own = _neighbours("_starts", lambda a, b: F.least(b - a, F.lit(width).cast("long")))
    covered = F.aggregate(own, F.lit(width).cast("long"), lambda total, x: total + x)
    return df.select("*", F.when(F.size("_starts") == 0, F.lit(0).cast("long"))
                     .otherwise(covered).alias("_covered"))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements of ``MEASURES`` (long)."""
    kept = without(docs, MEASURES).columns
    text = F.coalesce(F.col("_text"), F.lit(""))
    w = F.col("_words")
    k = REPEAT_WINDOW
    # a projection of its own per step, so that each array is made once
    # the input's columns travel in one struct: the steps' names can't clash
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
                      F.col(text_col).cast("string").alias("_text"))
    split = row.select(
        "*", words(text).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")
        .alias("_lines"))
    hashed = split.select("*", F.transform(w, lambda x: F.xxhash64(x)).alias("_h"))
    windows = F.when(F.size("_h") < k, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.slice("_h", 1, F.size("_h") - (k - 1)),
        lambda x, i: F.xxhash64(x, *[F.get(F.col("_h"), i + j) for j in range(1, k)])))
    ready = _repeat_words(hashed.select("*", windows.alias("_hashes")), k)
    longs = {
        "n_words": F.size("_words"),
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.col("_covered"),
        "n_lines": F.size("_lines"),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
        "n_marks": F.regexp_count(text, F.lit("!")),
    }
    # a generator of one row: a filter on the measurements stays above it, where they
    # are columns, instead of being pushed down as their whole expressions
    one = F.array(F.struct(*[c.cast("long").alias(n) for n, c in longs.items()]))
    return ready.select("_row", F.inline(one)).select(
        *[F.col(f"_row.`{c}`") for c in kept], *MEASURES)


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with measurements and ``failures``: bit i set if rule i fails."""
    bits = [F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
            for i, cond in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(docs, text_col).withColumn("failures", total)


def fails(policy: str, failures: str = "failures") -> Column:
    """Whether a ledger row breaks a rule of the policy."""
    return F.col(failures).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) != 0


def apply_policy(ledger_df: DataFrame, policy: str = CURRENT) -> DataFrame:
    return ledger_df.withColumn("kept", ~fails(policy))


def ablations(ledger_df: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: failed (documents that break it), only (documents
    that break no other rule of the policy: what leaving it out would return),
    kept_without (documents kept by the policy without it).  One aggregate over
    the ledger; ``any_bits`` is the union of all failures."""
    m = mask(POLICIES[policy])
    bits = F.col("failures").bitwiseAND(F.lit(m).cast("long"))
    aggs = [F.coalesce(F.bit_or(bits), F.lit(0)).alias("any_bits"), F.count(F.lit(1)).alias("n_docs"),
            F.count_if(bits == 0).alias("kept")]
    names = POLICIES[policy]
    for r in names:
        b = F.lit(mask([r])).cast("long")
        aggs += [F.count_if(bits.bitwiseAND(b) != 0).alias(f"failed_{r}"),
                 F.count_if(bits == b).alias(f"only_{r}")]
    one = ledger_df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(
        F.lit(r).alias("rule"), F.col(f"failed_{r}").alias("failed"), F.col(f"only_{r}").alias("only"),
        (F.col("kept") + F.col(f"only_{r}")).alias("kept_without")) for r in names]))
    return one.select(F.lit(policy).alias("policy"), "n_docs", "kept", "any_bits", rows.alias("r")) \
        .select("policy", "n_docs", "kept", "any_bits", "r.*")
