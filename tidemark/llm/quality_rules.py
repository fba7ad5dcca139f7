"""Quality rules: a short-circuit cascade ordered by rejection per cost.

Each rule is a native predicate on a text that is true for a text it rejects.
On a bounded sample every rule is run alone for its time and its verdicts; the
cascade then takes, again and again, the rule that rejects most of the rows still
standing per second, and is one CASE expression whose later rules are evaluated
only for rows that passed the earlier ones.  The order changes the work, never
the verdict.

Words are maximal runs other than the ASCII space, tab, line feed, vertical tab,
form feed and carriage return.

Edge cases: a null text has no words (all counts 0, ``base_failed``); an empty
sample or equal rates leave the rules in the order given; repeated rows and null
ids give a row each; extra columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
SAMPLE = 500


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(inner != "", F.split(inner, "[ \\t-\\r]+")).otherwise(F.array().cast("array<string>"))


def without(text: Column, pattern: str) -> Column:
    """Code points outside the pattern's characters."""
    return F.char_length(F.regexp_replace(text, pattern, ""))


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    return bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def repeated_words(words: Column) -> Column:
    """Words that stand in a window of three words met twice or more."""

    def window_hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bound(F.sort_array(bound(placed, met_again)), spread)

    def met_again(p: Column) -> Column:
        def same(x: Column, j: Column) -> Column:
            return F.coalesce(x["h"] == F.get(p, j)["h"], F.lit(False))

        # A negative index gives null, hence no match.
        twice = F.transform(p, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]).otherwise(F.lit(-1)))
        return F.filter(twice, lambda i: i >= 0)

    def spread(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, j: F.least(F.lit(3), F.coalesce(F.get(starts, j + 1) - s, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def of(w: Column) -> Column:
        counted = bound(window_hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
        return F.when(F.size(w) < 3, 0).otherwise(counted)

    return bound(words, of)


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the base counts."""
    split = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_words", words(F.col("text")))
    counted = split.select(
        "doc_id",
        "text",
        bound(
            F.col("_words"),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeated_words(w).cast("long").alias("n_repeat_words"),
            ),
        ).alias("_w"),
        (F.char_length("text") - without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).cast("long").alias("n_dup_lines"),
    )
    return counted.select("doc_id", "text", "_w.n_words", "_w.word_chars", "n_symbols", "n_dup_lines", "_w.n_repeat_words")


#: Rejecting predicates on ``text``.
RULES: dict[str, Column | Callable[[], Column]] = {
    "symbols": lambda: F.char_length("text") - without(F.col("text"), SYMBOLS) > 0.06 * F.char_length("text"),
    "capitals": lambda: F.char_length("text") - without(F.col("text"), "\\p{Lu}") > 0.4 * F.char_length("text"),
    "exclamations": lambda: F.char_length("text") - without(F.col("text"), "[!]") > 0.06 * F.char_length("text"),
    "duplicate lines": lambda: 2 * duplicate_lines(F.col("text")) > F.size(F.split("text", "\n")),
    "word length": lambda: bound(words(F.col("text")), lambda w: (F.size(w) > 0) & (F.char_length(F.array_join(w, "")) > 20 * F.size(w))),
    "few letters": lambda: without(F.col("text"), "[^\\p{L}]") < 0.5 * F.char_length("text"),
}


def ordered(docs: DataFrame, rules: dict[str, Callable[[], Column]], sample: int = SAMPLE) -> list[str]:
    """Names of the rules by rejection of what is left per second, on at most ``sample`` rows."""
    ids = docs.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    wanted = [r["doc_id"] for r in ids.collect()]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.col("doc_id").isin(wanted)).limit(sample)
    rows = base.stored(rows, "rule-sample").coalesce(1)
    verdicts, seconds = {}, {}
    for name, rule in rules.items():
        frame = rows.select("doc_id", F.coalesce(rule(), F.lit(False)).alias("bad")).orderBy("doc_id")
        tries = []
        for _ in range(2):
            begun = time.perf_counter()
            verdicts[name] = [r["bad"] for r in frame.collect()]
            tries.append(time.perf_counter() - begun)
        seconds[name] = max(min(tries), 1e-6)
    standing, order, left = set(range(len(next(iter(verdicts.values()), [])))), [], list(rules)
    while left:
        best = max(left, key=lambda n: sum(verdicts[n][i] for i in standing) / seconds[n])
        order.append(best)
        left.remove(best)
        standing -= {i for i in standing if verdicts[best][i]}
    return order


def cascade(rules: dict[str, Callable[[], Column]], order: list[str]) -> Column:
    """Name of the first rule that rejects, else null."""
    found = F.lit(None).cast("string")
    for name in reversed(order):
        found = F.when(rules[name](), F.lit(name)).otherwise(found)
    return found


def filtered(docs: DataFrame, rules: dict[str, Callable[[], Column]] | None = None) -> DataFrame:
    """Base counts, ``base_failed``, ``kept`` and ``rejected_by`` of every row."""
    rules = RULES if rules is None else rules
    order = ordered(docs, rules)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = measured(docs).withColumn("base_failed", failed)
    judged = judged.withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(rules, order)))
    return judged.withColumn("kept", F.col("rejected_by").isNull()).drop("text")


def query(spark, folder: str) -> DataFrame:
    # Which of several rejecting rules comes first depends on the measured order: not a column of the result.
    return filtered(base.read(spark, folder)).drop("rejected_by")


ORACLE = r"""
with d as (
  select row_number() over () as k, doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents
), w as (
  select k, unnest(words) as word, generate_subscripts(words, 1) as pos from d
), t as (
  select k, pos, word || ' ' || lead(word, 1) over o || ' ' || lead(word, 2) over o as tri
  from w window o as (partition by k order by pos)
), again as (
  select k, pos from t where tri is not null qualify count(*) over (partition by k, tri) > 1
), covered as (
  select k, count(distinct pos + step) as n from again, (select unnest([0, 1, 2]) as step) group by k
), m as (
  select doc_id, text, lines, words, cast(len(words) as bigint) as n_words,
         cast(length(array_to_string(words, '')) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
         cast(coalesce(n, 0) as bigint) as n_repeat_words
  from d left join covered using (k)
), j as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         n_symbols > 0.06 * length(text)
         or length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) > 0.4 * length(text)
         or length(text) - length(replace(text, '!', '')) > 0.06 * length(text)
         or 2 * n_dup_lines > len(string_split(text, chr(10)))
         or (n_words > 0 and word_chars > 20 * n_words)
         or length(regexp_replace(text, '[^\p{L}]', '', 'g')) < 0.5 * length(text) as rejected
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not rejected as kept
from j
"""
