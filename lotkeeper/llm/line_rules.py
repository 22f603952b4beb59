r"""Line-first quality rules: lines are judged by themselves, then documents by what their lines lose.

Every line passes or fails three groups of rules. A document that loses more than ``max_loss`` percent of its
characters with the failing lines is rejected; other documents keep what passed. All in Spark's own
functions, one pass, no shuffle: every document is judged by itself.

The figures of a document (words are runs of anything but space and \x09-\x0D):

* n_words; word_chars, the code points in words; n_symbols, characters of ``#*$%&|<>``
* n_dup_lines: lines with a word that equal an earlier line
* n_repeat_words: words inside a three-word window that the text has twice or more (windows are compared
  by 64-bit hashes)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotkeeper.llm.words import BLANKS, blank, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT = 50
#: Percent of a document's word characters that its failing lines may hold.
MAX_LOSS = 30
#: Patterns of one line, trimmed. They read the same in Java and RE2.
ENDS_WELL = r"""[.!?:;…。！？"”’»')\]]$"""
SEPARATOR = r"(^| )[|»›>·•→]( |$)"
#: A line of this many words or more shouts if it has capitals and no small letter.
SHOUT_WORDS = 3
CAPITAL, SMALL = r"\p{Lu}", r"\p{Ll}"
BOILERPLATE = (r"(?i)(javascript|lorem ipsum|cookie|privacy policy|terms of (use|service)|all rights reserved"
               r"|click here|read more|sign (in|up)|log in|subscribe to|share (this|on)|back to top"
               r"|skip to content)")
#: A line counts as a notice when it holds such a phrase and has at most this many words.
NOTICE_WORDS = 20


def stripped(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def line_passes(line: Column) -> Column:
    """Whether a trimmed line with a word passes the punctuation, navigation and boilerplate rules."""
    n = F.size(F.array_remove(F.split(line, " "), ""))
    symbols = F.length(line) - F.length(stripped(line, SYMBOLS))
    punctuation = line.rlike(ENDS_WELL)
    navigation = F.regexp_count(line, F.lit(SEPARATOR)) * 4 >= n
    shout = (n >= SHOUT_WORDS) & ~line.rlike(SMALL) & line.rlike(CAPITAL)
    boilerplate = (symbols * 5 > n) | shout | ((n <= NOTICE_WORDS) & line.rlike(BOILERPLATE))
    return punctuation & ~navigation & ~boilerplate


def repeated_words(found: Column) -> Column:
    """Positions covered by windows of three words that occur twice or more, counted."""
    n = F.size(found)
    less = lambda k: F.greatest(n - k, F.lit(0))
    hashes = F.zip_with(F.zip_with(F.slice(found, F.lit(1), less(2)), F.slice(found, F.lit(2), less(2)),
                                   lambda a, b: F.struct(a, b)),
                        F.slice(found, F.lit(3), less(2)), lambda ab, c: F.xxhash64(ab, c))
    return hashes


def quality(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
            max_repeat: int = MAX_REPEAT, max_loss: int = MAX_LOSS) -> DataFrame:
    """Judge every document: its figures, ``base_failed`` (too few words, or more than ``max_repeat`` percent
    repeated), ``lost_chars`` (word characters in failing lines), ``kept`` and ``clean_text``, the passing lines.

    Null text has no words, fails and gives a null clean_text; a line without a word is neither judged nor lost.
    Rows stay one to one, in repeated rows too; of the input's columns id and text only are read.
    """
    text = F.col("_text")
    one = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")).withColumn(
        "_words", words(text)).withColumn("_lines", F.split(blank(text), "\n"))
    n = F.size("_words")
    two = one.select(
        "doc_id", "_text", n.cast("long").alias("n_words"),
        F.coalesce(F.length(stripped(text, BLANKS)), F.lit(0)).cast("long").alias("word_chars"),
        F.coalesce(F.length(text) - F.length(stripped(text, SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: F.length(stripped(x, BLANKS)) > 0).alias("_worded"),
        repeated_words(F.col("_words")).alias("_windows"),
        F.array_join(F.filter("_lines", lambda x: (F.trim(x) == "") | line_passes(F.trim(x))), "\n").alias("clean_text"))
    places = F.sequence(F.lit(0), F.size("_windows") - 1)
    ordered = F.sort_array(F.zip_with("_windows", places, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    three = two.withColumn("_ordered", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"), ordered))
    rest = F.size("_ordered") - 1
    # a window is repeated if its neighbour in the order of hashes, on either side, has its hash
    same = F.zip_with(F.slice("_ordered", F.lit(1), rest), F.slice("_ordered", F.lit(2), rest),
                      lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], a["i"] + 1, a["i"] + 2,
                                                                    b["i"], b["i"] + 1, b["i"] + 2)))
    repeat = F.coalesce(F.size(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull())))), F.lit(0))
    four = three.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        F.greatest(F.size("_worded") - F.size(F.array_distinct("_worded")), F.lit(0)).cast("long").alias("n_dup_lines"),
        F.when(F.col("_ordered").isNull(), F.lit(0)).otherwise(repeat).cast("long").alias("n_repeat_words"),
        (F.col("word_chars") - F.coalesce(F.length(stripped(F.col("clean_text"), BLANKS)), F.lit(0))).alias("lost_chars"),
        "clean_text")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return four.select(
        F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "lost_chars",
        (~failed & (100 * F.col("lost_chars") <= max_loss * F.col("word_chars"))).alias("kept"), "clean_text")


def quality_sql(source: str = "documents") -> str:
    """The same figures in SQL, by joins and windows over rows of words and lines."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    blanks = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
    body = "trim(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    '))"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM {source}),
ws AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (
         SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs)),
tri AS (SELECT r, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS t FROM ws
        WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS c FROM tri WHERE t IS NOT NULL),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1 GROUP BY r),
ls AS (SELECT r, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (
         SELECT r, string_split(text, chr(10)) AS l FROM docs)),
lines AS (SELECT r, line, {body} AS b FROM ls),
judged AS (SELECT r, line, b, len(list_filter(string_split(b, ' '), lambda x: x <> '')) AS n,
             length(b) - length(translate(b, {quote(SYMBOLS)}, '')) AS symbols FROM lines WHERE b <> ''),
per_line AS (SELECT r, count(*) - count(DISTINCT line) AS dups,
             sum(CASE WHEN regexp_matches(b, {quote(ENDS_WELL)})
                  AND NOT len(regexp_extract_all(b, {quote(SEPARATOR)})) * 4 >= n
                  AND NOT symbols * 5 > n
                  AND NOT (n >= {SHOUT_WORDS} AND NOT regexp_matches(b, {quote(SMALL)}) AND regexp_matches(b, {quote(CAPITAL)}))
                  AND NOT (n <= {NOTICE_WORDS} AND regexp_matches(b, {quote(BOILERPLATE)}))
                 THEN 0 ELSE length(translate(b, ' ', '')) END) AS lost FROM judged GROUP BY r),
counts AS (SELECT r, count(*) AS n, sum(length(word)) AS chars FROM ws GROUP BY r),
figures AS (SELECT doc_id, coalesce(c.n, 0) AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
             coalesce(length(text) - length(translate(text, {quote(SYMBOLS)}, '')), 0) AS n_symbols,
             coalesce(dups, 0) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_chars
  FROM docs LEFT JOIN counts c USING (r) LEFT JOIN covered v USING (r) LEFT JOIN per_line USING (r)),
failing AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_chars,
  NOT base_failed AND 100 * lost_chars <= {MAX_LOSS} * word_chars AS kept FROM failing"""
