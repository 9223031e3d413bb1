"""Quality rules as a bitmask ledger (DataFrame expressions only).

``ledger`` measures every text once and evaluates every rule once. It stores
the measurements and, in one long, a bit per failed rule. Policies are versioned
sets of rules: a policy is a mask, and a document passes it if no bit of the mask
is set. ``ablation`` answers from the stored bits what each rule costs or
adds under a policy, without a second look at the texts.

Edge cases: a null text counts as empty (no words, so too short); ties do not
arise; a repeated row is judged like any other; an empty table gives an empty
ledger; further columns of the input are kept unless they bear a ledger
column's name, which the ledger's own value replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Scripts written without blanks between words.
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")

#: ``n_unspaced``, the characters of UNSPACED, is counted only where ``word_chars`` exceeds LONG_WORD a word, else 0.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines", "n_unspaced")
LONG_WORD = 20

#: The rules, in bit order: a name and a SQL condition on the measurements that
#: is true if the document fails. The first two are the contract's base rules.
RULES: tuple[tuple[str, str], ...] = (
    ("too_short", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbol_heavy", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("shouting", "2 * n_upper > word_chars"),
    ("word_length", f"word_chars < 2 * n_words or word_chars - n_unspaced > {LONG_WORD} * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: Versioned policies; a later version never changes an earlier one.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("too_short", "repeated_windows"),
    "v2": tuple(name for name, _ in RULES),
}
BASE = "v1"
CURRENT = "v2"


def mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def _length_without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _with_repeat_words(frame: DataFrame) -> DataFrame:
    """``frame`` with ``__rep``: the words of ``__w`` that lie in an 8-word window found twice or more.

    Windows are 64-bit hashes. Only a text that has an equal pair goes on: its
    hashes are sorted with their positions, so equal windows stand side by side,
    n log n for a text of any length. A window's words are counted once: its cover
    ends where the next repeated window begins. Every step is a column of its
    own, because a lambda evaluates what it refers to for each element.
    """
    n = F.size("__w")
    frame = frame.withColumn("__k", F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("__w", i, WINDOW)))))
    some = F.size(F.array_distinct("__k")) < F.size("__k")
    frame = frame.withColumn("__o", F.when(some, F.sort_array(F.transform(
        "__k", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def twin(x: Column, k: Column) -> Column:
        near = [F.coalesce(F.get("__o", j)["h"] == x["h"], F.lit(False)) for j in (k - 1, k + 1)]
        return near[0] | near[1]

    frame = frame.withColumn("__p", F.sort_array(F.transform(F.filter("__o", twin), lambda x: x["i"])))
    cover = F.aggregate(
        "__p", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("p")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["p"])).alias("n"), p.alias("p")),
        lambda a: a["n"])
    return frame.withColumn("__rep", F.coalesce(cover, F.lit(0)))


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``keep`` (all columns by default), the MEASURES and ``failed`` bits."""
    own = {"__t", "__w", "__l", "__k", "__o", "__p", "__rep", *MEASURES, "failed"}
    keep = tuple(c for c in (docs.columns if keep is None else keep) if c not in own)
    base = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(text), F.lit("")).alias("__t"))
    cut = base.withColumn("__w", F.filter(F.split("__t", SPLIT), lambda w: w != "")).withColumn(
        "__l", F.filter(F.split("__t", "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0))
    cut = _with_repeat_words(cut)
    t, w, lines = F.col("__t"), F.col("__w"), F.col("__l")
    chars = _length_without(t, WHITE)
    others = "[^" + "".join(rf"\p{{Is{name}}}" for name in UNSPACED) + "]+"
    unspaced = F.when(chars > LONG_WORD * F.size(w), F.length(F.regexp_replace(t, others, ""))).otherwise(F.lit(0))
    values = (
        F.size(w), chars, F.length(t) - _length_without(t, SYMBOLS), F.size(lines) - F.size(F.array_distinct(lines)),
        F.col("__rep"), F.length(t) - _length_without(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.size(lines), unspaced)
    # A one-row generator keeps later filters from being pushed below, where every condition
    # would evaluate the measurements anew.
    measured = cut.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(F.struct(
        *[v.cast("long").alias(name) for name, v in zip(MEASURES, values, strict=True)]))))
    bits = F.lit(0).cast("long")
    for name, fails in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed", bits)


def passes(policy: str, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(table: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents failing it, failing it alone (kept if the rule went), and the policy's kept count."""
    m = F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long"))
    counts = table.groupBy(m.alias("bits")).agg(F.count("*").alias("n"))
    rows = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in POLICIES[policy]]))
    return (counts.select("bits", "n", rows.alias("r")).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
                 F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("n_kept")))


def quality(docs: DataFrame) -> DataFrame:
    """The contract's row per document: measurements, base verdict, the current policy's verdict, and the bits."""
    led = ledger(docs.select("doc_id", "text"))
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        (passes(BASE) & passes(CURRENT)).alias("kept"), "failed")


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that pass a policy, with their columns unchanged."""
    row = docs.select(F.struct("*").alias("__row"), F.col("text"))
    led = ledger(row, keep=("__row",))
    return led.filter(passes(policy)).select("__row.*")
