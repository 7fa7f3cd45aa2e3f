"""Line-first quality rules, native SQL functions only.

Every line with a word is judged by itself:

* punctuation: it has no sentence end (a mark of any script before a blank or the line's end; Thai and Lao, which
  write none, need none), or pairs of ``!`` or ``?`` are at least 3 for 10 words, or it shouts (upper-case
  letters only, 3 words at least);
* navigation: symbols ``#*$%&|<>`` are at least 3 for 10 words, or it is a list of menu words only;
* boilerplate: it holds one of the page notices listed below.

Failing lines are removed; a document whose removed lines hold over 40 % of its words is rejected, as
is one that fails the base rules (under 10 words, or over 20 % of the words in repeated 5-word windows).

Counting is done with plain string functions; regular expressions run only where they end early on
ordinary lines, since they take most of the time otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
_CLOSED = r"""["')\]»”’]*([\x20\x09-\x0D]|$)"""
SENTENCE_END = "[.!?…。！？]" + _CLOSED
#: Marks of Indic, Sinhala, Arabic, Armenian, Ethiopic, Burmese, Khmer, Tibetan and Mongolian script and further CJK forms, or a
#: letter of Thai or Lao, which close sentences with a blank only. Looked for where the marks above are missing.
OTHER_END = "[।॥෴۔؟։՜՞።፧፨၊။។៕៖།༎᠃᠉．｡]" + _CLOSED + "|[ก-๛ກ-ໟ]"
MENU_LINE = (r"(?i)^[\x20\x09-\x0D/·-]*((home|menu|login|log in|sign in|sign up|register|search|contact|contact us|about|about us|next|"
             r"previous|back|top|share|print|archive|sitemap|faq|help)[\x20\x09-\x0D/·-]*)+$")
#: Looked for as written and with a capital first letter.
NOTICES = ["all rights reserved", "©", "accept cookies", "accept all cookies", "uses cookies", "use cookies", "cookie policy",
           "privacy policy", "terms of use", "terms of service", "enable javascript", "subscribe to our", "click here",
           "read more", "lorem ipsum", "back to top", "powered by"]
LOST_PERCENT = 40

_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _words(blank_separated: Column) -> Column:
    return F.array_remove(F.split(blank_separated, " ", -1), "")


def _occurrences(text: Column, piece: str) -> Column:
    """Non-overlapping occurrences of an ASCII string."""
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(piece), F.lit("")))) / len(piece)


def _symbols(text: Column) -> Column:
    return reduce(Column.__add__, [_occurrences(text, c) for c in SYMBOLS]).cast("long")


def _notice(text: Column) -> Column:
    wanted = [v for n in NOTICES for v in dict.fromkeys([n, n.capitalize()])]
    return reduce(Column.__or__, [F.contains(text, F.lit(v)) for v in wanted])


def _fails(line: Column, words: Column, any_symbol: Column, any_notice: Column) -> Column:
    pairs = _occurrences(line, "!!") + _occurrences(line, "??")
    shouts = (words >= 3) & ~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}")
    # both flags of the text stand here twice, so that the optimizer keeps them as columns and
    # does not move their computation into the work on each line
    rare = (any_symbol | any_notice) & ((any_symbol & (10 * _symbols(line) >= 3 * words)) | (any_notice & _notice(line)))
    return (words > 0) & ((~line.rlike(SENTENCE_END) & ~line.rlike(OTHER_END)) | (10 * pairs >= 3 * words) | shouts | line.rlike(MENU_LINE) | rare)


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add __n_repeat_words from __words: how many words lie in a 5-word window found twice or more."""
    words = F.col("__words")
    df = df.withColumn("__windows", F.transform(
        F.slice(F.sequence(F.lit(0), F.size("__words")), 1, F.greatest(F.size("__words") - 4, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(5)])))
    # only texts with an equal pair of windows need their positions sorted out
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    df = df.withColumn("__sorted", F.when(repeats, F.sort_array(F.transform(
        "__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    ordered = F.col("__sorted")
    twin = lambda x, k: F.coalesce(x["h"] == F.get(ordered, k)["h"], F.lit(False))
    df = df.withColumn("__at", F.sort_array(F.transform(
        F.filter("__sorted", lambda x, k: twin(x, k - 1) | twin(x, k + 1)), lambda x: x["i"])))
    starts = F.col("__at")
    return df.withColumn("__n_repeat_words", F.coalesce(F.aggregate(
        F.transform("__at", lambda p, k: F.least(F.lit(5), F.coalesce(p - F.get(starts, k - 1), F.lit(5)))),
        F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))


def assess(docs: DataFrame) -> DataFrame:
    """``docs`` plus the columns __n_words, __word_chars, __n_symbols, __n_dup_lines,
    __n_repeat_words, __lost_words (long), __base_failed, __kept (boolean) and __clean (the text
    without failing lines).

    Works row by row without a shuffle. A null text counts as empty: no words, base_failed, not
    kept, and __clean null. Blank lines never fail. Rows, ids and other columns may be null or
    repeated: each row is judged by its own text. Column names that start with ``__`` are reserved.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    odd_blank = reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in "\t\x0b\x0c\r"])
    df = docs.withColumn("__text", F.when(odd_blank, F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text))
    df = df.withColumn("__lines", F.split("__text", "\n", -1))
    df = df.withColumn("__words", _words(F.replace("__text", F.lit("\n"), F.lit(" "))))
    df = _repeat_words(df.withColumn("__n_words", F.size("__words").cast("long")))
    df = df.withColumn("__n_symbols", _symbols(F.col("__text"))).withColumn("__notice", _notice(F.col("__text")))
    df = df.withColumn("__symbol", F.col("__n_symbols") > 0)
    df = df.withColumn("__counted", F.transform("__lines", lambda x: F.struct(x.alias("line"), F.size(_words(x)).alias("words"))))
    df = df.withColumn("__failed", F.transform("__counted", lambda x: F.when(
        _fails(x["line"], x["words"], F.col("__symbol"), F.col("__notice")), x["words"]).otherwise(0)))
    failed = F.col("__failed")
    worded = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = (df.withColumn("__lost_words", F.aggregate("__failed", F.lit(0).cast("long"), lambda a, x: a + x))
          .withColumn("__word_chars", F.length(F.replace(F.replace("__text", F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))).cast("long"))
          .withColumn("__n_dup_lines", F.when(F.size(F.array_distinct("__lines")) == F.size("__lines"), 0)
                      .otherwise(F.size(worded) - F.size(F.array_distinct(worded))).cast("long"))
          .withColumn("__base_failed", (F.col("__n_words") < 10) | (100 * F.col("__n_repeat_words") > 20 * F.col("__n_words"))))
    lost_too_much = 100 * F.col("__lost_words") > LOST_PERCENT * F.col("__n_words")
    clean = F.when(F.col("__lost_words") == 0, F.col("text")).otherwise(F.array_join(
        F.filter(F.split("text", "\n", -1), lambda x, i: F.get(failed, i) == 0), "\n"))
    df = df.withColumn("__kept", ~F.col("__base_failed") & ~lost_too_much).withColumn("__clean", clean)
    return df.select(*docs.columns, *[f"__{c}" for c in [*_BASE, "lost_words", "base_failed", "kept", "clean"]])


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, lost_words and kept."""
    return assess(docs.select("doc_id", "text")).select(
        "doc_id", *[F.col(f"__{c}").alias(c) for c in [*_BASE, "base_failed", "lost_words", "kept"]])


def keep_clean(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their failing lines removed and n_chars renewed if present."""
    # the row number keeps the optimizer from moving the filter below the steps of assess(), where it
    # would repeat their expressions inside one another
    df = assess(docs).withColumn("__row", F.monotonically_increasing_id()).filter("__kept and __row >= 0")
    new = {"text": F.col("__clean"), "n_chars": F.length("__clean").cast("long")}
    return df.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


#: The same results in DuckDB SQL (regular expressions as above, with its own flags).
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
win AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d)
),
rep AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM win), range(5) r(k)
  WHERE n > 1 GROUP BY rid
),
lines AS (
  SELECT rid, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         regexp_matches(line, '__END__') OR regexp_matches(line, '__OTHER__') AS ended,
         len(regexp_extract_all(line, '!!|\?\?')) AS pairs,
         NOT regexp_matches(line, '\p{Ll}') AND regexp_matches(line, '\p{Lu}') AS shouts,
         len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
         regexp_matches(line, '__MENU__') OR __NOTICE__ AS notice
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
),
ld AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines,
         coalesce(sum(words) FILTER (WHERE NOT ended OR 10 * pairs >= 3 * words OR (shouts AND words >= 3)
           OR 10 * symbols >= 3 * words OR notice), 0) AS lost_words
  FROM lines WHERE words > 0 GROUP BY rid
),
b AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(lost_words, 0)::BIGINT AS lost_words
  FROM d LEFT JOIN rep USING (rid) LEFT JOIN ld USING (rid)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (100 * lost_words > __LOST__ * n_words) AS kept
FROM b
""".replace("__END__", SENTENCE_END.replace("'", "''")).replace("__OTHER__", OTHER_END.replace("'", "''")).replace("__MENU__", MENU_LINE).replace("__NOTICE__", " OR ".join(
    f"contains(line, '{v}')" for n in NOTICES for v in dict.fromkeys([n, n.capitalize()]))).replace("__LOST__", str(LOST_PERCENT))
