"""Quality rules, line first: clean the lines, then judge what is left of the document.

Each line with a word is tested by itself for punctuation, navigation and boilerplate;
failing lines are removed, and a document that loses too much of its text is rejected.
Everything is built-in expressions over one row, so no row meets another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightgrid.llm.common import replaced, table

LEAST_WORDS = 50
REPEAT_PERCENT = 50
#: A document must keep this percentage of its line characters.
KEEP_PERCENT = 50

SYMBOLS = "[#*$%&|<>]"
#: A line is noise when more than this percentage of its characters are symbols.
SYMBOL_PERCENT = 10
#: ... or shouting, when it has so many capitals in percent of its characters ...
CAPITAL_PERCENT, CAPITAL_CHARS = 50, 20
#: ... or navigation, with so many separators or, without a sentence end, so few words.
NAVIGATION_SEPARATORS, NAVIGATION_WORDS = 3, 3
#: ... in at most so many characters, since scripts without blanks have few words.
NAVIGATION_CHARS = 40

#: Patterns that Java's and RE2's engines read alike.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SENTENCE_END = r"[.!?:;,\x22')\]。！？…][\x20\x09-\x0D]*$"
SEPARATOR = r"(^|[\x20\x09-\x0D])(\||>|>>|/|-|\*|::)([\x20\x09-\x0D]|$)"
#: Phrases that are boilerplate wherever they stand as whole words.
STRONG = (
    r"(?:all rights reserved|privacy policy|terms of (?:use|service)|enable javascript|lorem ipsum|licensed under"
    r"|license, version|we use cookies|accept (?:all )?cookies|cookie (?:policy|settings|notice)|copyright \(c\) [0-9]{4}|copyright [0-9]{4}"
    r"|alle rechte vorbehalten|tous droits|politique de confidentialit|mentions l.?gales|todos los derechos|pol.?tica de privacidad|aviso legal)"
)
#: Signs that also stand in plain sentences: one fails a line of few words, two any line.
WEAK = (
    r"(?:copyright|cookies?|click here|read more|sign (?:in|up)|log ?in|subscribe|newsletter|share (?:on|this)"
    r"|datenschutz|impressum|hier klicken|weiterlesen|anmelden|cliquez ici|lire la suite|haga clic|leer m.?s)"
)
WEAK_WORDS = 5


def _boilerplate(before: str, after: str) -> tuple[str, str, str]:
    """Patterns of a strong phrase, a weak sign and two weak signs, given an engine's word bounds."""
    strong, weak = (before + words + after for words in (STRONG, WEAK))
    return "(?i)" + strong, "(?i)" + weak, f"(?is){weak}.*{weak}"


#: No letter, digit or underscore of ASCII may touch a phrase; RE2 has no lookaround, its \b means the same.
JAVA_SIGNS = _boilerplate("(?<![0-9A-Za-z_])", "(?![0-9A-Za-z_])")
RE2_SIGNS = _boilerplate(r"\b", r"\b")
_CAPITALS = "[A-Z]"
_SPACES = " \t\n\x0b\f\r"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _count_of(text: Column, chars: str) -> Column:
    """How many characters of a class a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, chars, ""))


def line_passes(line: Column) -> Column:
    """Whether a line with a word passes all line rules."""
    size = F.length(line)
    ends = line.rlike(SENTENCE_END)
    n_words = F.size(F.split(F.trim(line, F.lit(_SPACES)), SPACE + "+"))
    separators = F.size(F.split(line, SEPARATOR)) - 1
    noisy = 100 * _count_of(line, SYMBOLS) > SYMBOL_PERCENT * size
    shouting = (size >= CAPITAL_CHARS) & (100 * _count_of(line, _CAPITALS) > CAPITAL_PERCENT * size)
    navigation = (separators >= NAVIGATION_SEPARATORS) | (~ends & (size <= NAVIGATION_CHARS) & (n_words <= NAVIGATION_WORDS))
    strong, weak, two = JAVA_SIGNS
    # Most lines have no weak sign, so how many words or signs there are is rarely looked at.
    boilerplate = line.rlike(strong) | (line.rlike(weak) & ((n_words <= WEAK_WORDS) | line.rlike(two)))
    return ~noisy & ~shouting & ~navigation & ~boilerplate


def clean_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``cleaned``, ``kept_chars``, ``line_chars`` and ``kept``.

    ``cleaned``: the passing lines in their order.  A null text counts as an empty one;
    it has no words and so fails the base rule.  Columns of the result's names are replaced.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    bare = F.trim(F.col("__llm_whole"), F.lit(_SPACES))
    lines = F.filter(F.split("__llm_whole", "\n"), lambda line: line.rlike(WORD))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))
    # Each select names what the next one uses more than once, so nothing is computed twice.
    step = replaced(docs, {"__llm_whole": whole})
    step = replaced(step, {"__llm_words": words, "__llm_lines": lines})
    step = replaced(step, {"__llm_hashes": F.transform("__llm_words", lambda w: F.xxhash64(w)), "__llm_passing": F.filter("__llm_lines", line_passes)})
    windows = F.transform(
        F.slice("__llm_hashes", 1, F.greatest(F.size("__llm_hashes") - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get("__llm_hashes", i + 1), F.get("__llm_hashes", i + 2)),
    )
    # Of a sorted number the high bits are a window's hash and the low ones its place, so
    # windows sort as plain numbers; equal high bits are checked by the whole hashes.
    place_bits = F.ceil(F.log2(F.size("__llm_hashes") + F.lit(2.0))).cast("int")
    step = replaced(step, {
        "__llm_windows": windows, "__llm_mask": F.call_function("shiftleft", F.lit(-1).cast("long"), place_bits),
    })
    marked = F.transform("__llm_windows", lambda h, i: h.bitwiseAND(F.col("__llm_mask")).bitwiseOR(i.cast("long")))
    step = replaced(step, {"__llm_sorted": F.sort_array(marked)})

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.bitwise_not("__llm_mask")).cast("int")

    def equal(x: Column, other: Column) -> Column:
        near = x.bitwiseXOR(other).bitwiseAND(F.col("__llm_mask")) == 0
        same = F.get("__llm_windows", place(x)) == F.get("__llm_windows", place(other))
        return F.coalesce(near & same, F.lit(False))

    repeated = F.transform(
        "__llm_sorted",
        lambda w, k: F.when(equal(w, F.get("__llm_sorted", k + 1)) | equal(w, F.get("__llm_sorted", k - 1)), place(w)),
    )
    step = replaced(step, {"__llm_places": F.sort_array(F.array_compact(repeated))})
    covered = F.aggregate(
        F.transform("__llm_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("__llm_places", k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda total, n: total + n,
    )
    n_words = F.size("__llm_hashes").cast("long")
    step = replaced(step, {
        "n_words": n_words,
        "word_chars": F.length(F.array_join("__llm_words", "")).cast("long"),
        "n_symbols": _count_of(F.col("__llm_whole"), SYMBOLS).cast("long"),
        "n_dup_lines": (F.size("__llm_lines") - F.size(F.array_distinct("__llm_lines"))).cast("long"),
        "n_repeat_words": covered,
        "cleaned": F.array_join("__llm_passing", "\n"),
        "kept_chars": F.length(F.array_join("__llm_passing", "")).cast("long"),
        "line_chars": F.length(F.array_join("__llm_lines", "")).cast("long"),
    }).drop(
        "__llm_whole", "__llm_words", "__llm_hashes", "__llm_windows", "__llm_mask", "__llm_sorted", "__llm_places", "__llm_lines", "__llm_passing"
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    kept = ~failed & (100 * F.col("kept_chars") >= KEEP_PERCENT * F.col("line_chars"))
    return replaced(step, {"base_failed": failed, "kept": kept})


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_lines(docs).select("doc_id", *BASE, "base_failed", "kept")


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _count_sql(text: str, chars: str) -> str:
    return f"(length({text}) - length(regexp_replace({text}, '{chars}', '', 'g')))"


_SPACES_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), {_sql(SPACE + "+")}), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, {_sql(WORD)})) AS lines
  FROM documents),
places AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
           FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM places) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT k) AS n
            FROM (SELECT doc_id, unnest(range(i, i + 3)) AS k FROM again) GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
         {_count_sql("t", SYMBOLS)}::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, lines
  FROM d LEFT JOIN repeats USING (doc_id)),
single AS (SELECT doc_id, unnest(lines) AS l FROM counted),
tested AS (
  SELECT doc_id, length(l) AS size,
    100 * {_count_sql("l", SYMBOLS)} <= {SYMBOL_PERCENT} * length(l)
    AND NOT (length(l) >= {CAPITAL_CHARS} AND 100 * {_count_sql("l", _CAPITALS)} > {CAPITAL_PERCENT} * length(l))
    AND NOT (len(string_split_regex(l, {_sql(SEPARATOR)})) - 1 >= {NAVIGATION_SEPARATORS}
             OR (NOT regexp_matches(l, {_sql(SENTENCE_END)}) AND length(l) <= {NAVIGATION_CHARS}
                 AND len(string_split_regex(trim(l, {_SPACES_SQL}), {_sql(SPACE + "+")})) <= {NAVIGATION_WORDS}))
    AND NOT (regexp_matches(l, {_sql(RE2_SIGNS[0])}) OR (regexp_matches(l, {_sql(RE2_SIGNS[1])})
             AND (len(string_split_regex(trim(l, {_SPACES_SQL}), {_sql(SPACE + "+")})) <= {WEAK_WORDS}
                  OR regexp_matches(l, {_sql(RE2_SIGNS[2])})))) AS passes
  FROM single),
kept AS (SELECT doc_id, sum(size) AS line_chars, coalesce(sum(size) FILTER (WHERE passes), 0) AS kept_chars
         FROM tested GROUP BY doc_id),
failed AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * coalesce(kept_chars, 0) >= {KEEP_PERCENT} * coalesce(line_chars, 0) AS kept
FROM failed LEFT JOIN kept USING (doc_id)
"""
