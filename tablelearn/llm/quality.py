"""Quality rules, line first: judge every line, drop the failures, then reject
documents that lose too much text. DataFrame functions only.

Defined results: a null text counts as empty (no words, base_failed, not kept); a null
id stays null; repeated rows are judged one by one; an empty table gives an empty
result; columns that the rules do not use are ignored (``clean_lines`` passes them on). Very
long texts are judged whole, one row in memory; no rule has ties to break.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import count_chars, let, pick, words_col

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Phrases that mark a line as boilerplate (fixed values, lower case).
BOILERPLATE = (
    "all rights reserved", "click here", "cookie policy", "enable javascript", "licensed under",
    "log in to", "lorem ipsum", "privacy policy", "sign up for", "terms of use",
)


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules.

    ``max_symbol_words``: largest share of a line's words that hold a symbol or end in
    two or more exclamation or question marks (punctuation rule);
    ``min_navigation_bars``: so many `` | `` separators make a line navigation;
    ``terminal_min_words``: lines of at least so many words need sentence punctuation
    anywhere (punctuation rule);
    ``max_lost``: documents losing more than this share of their words are rejected.
    """

    max_symbol_words: float = 0.3
    min_navigation_bars: int = 2
    terminal_min_words: int = 20
    max_lost: float = 0.5


def _any(text: Column, parts) -> Column:
    found = F.lit(False)
    for p in parts:
        found = found | text.contains(p)
    return found


def text_flags(text: Column) -> Column:
    """Which rules any line of the text can break at all."""
    return F.struct(text.contains(" | ").alias("bars"),
                    let(F.lower(text), lambda x: _any(x, BOILERPLATE)).alias("phrases"),
                    _any(text, (*"#*$%&<>", "!!", "??", "!?", "?!")).alias("marks"))


def line_fails(line: Column, rules: LineRules, flags: Column) -> Column:
    """True when a line breaks a punctuation, navigation or boilerplate rule; ``flags``
    are its text's, so most lines need little more than the punctuation test."""
    bars = flags["bars"] & (
        F.length(line) - F.length(F.replace(line, F.lit(" | "), F.lit("  "))) >= rules.min_navigation_bars)
    phrases = flags["phrases"] & let(F.lower(line), lambda x: _any(x, BOILERPLATE))
    odd = F.size(F.split(line, r"[#*$%&<>]\S*|[!?]{2,}")) - 1
    symbols = flags["marks"] & line.rlike(r"[#*$%&<>]|[!?]{2}") & (
        odd > F.lit(rules.max_symbol_words) * F.size(words_col(line)))
    unpunctuated = ~line.rlike(r"[.!?…。]") & (F.size(words_col(line)) >= rules.terminal_min_words)
    return bars | symbols | unpunctuated | phrases


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more, from the word array."""

    def covered(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        again = let(pairs, lambda s: F.filter(s, lambda x, i: F.coalesce(
            F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
            F.get(s, i + 1)["h"] == x["h"], F.lit(False))))
        starts = F.sort_array(F.transform(again, lambda x: x["p"]))
        total = F.aggregate(
            starts, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n")),
            lambda a, p: F.struct(p.alias("last"),
                                  (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
            lambda a: a["n"])
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("bigint")).otherwise(total)

    windows = F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
                          lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    return let(windows, covered)


def judge(text: Column, rules: LineRules, with_text: bool) -> Column:
    """One struct per text: its counts, verdicts and (on request) the cleaned text. All
    shared parts are bound to lambda variables, so each is computed once."""

    def of_text(t: Column) -> Column:
        counts = let(words_col(t), lambda w: F.struct(
            F.size(w).cast("bigint").alias("n"), F.length(F.array_join(w, "")).cast("bigint").alias("chars"),
            _repeat_words(w).alias("rep")))

        def of_lines(lines: Column, c: Column, flags: Column) -> Column:
            full = F.filter(lines, _has_word)
            dup = (F.size(full) - F.size(F.array_distinct(full))).cast("bigint")
            lost = F.filter(lines, lambda x: line_fails(x, rules, flags))
            return let(lost, lambda bad: verdict(lines, c, dup, bad))

        def verdict(lines: Column, c: Column, dup: Column, bad: Column) -> Column:
            left = c["n"] - F.when(F.size(bad) == 0, F.lit(0)).otherwise(F.size(words_col(F.array_join(bad, "\n"))))
            failed = (c["n"] < 50) | (F.lit(100) * c["rep"] > F.lit(50) * c["n"])
            kept = ~failed & (left >= F.lit(1.0 - rules.max_lost) * c["n"])
            out = [c["n"].alias("n_words"), c["chars"].alias("word_chars"),
                   count_chars(t, SYMBOLS).cast("bigint").alias("n_symbols"), dup.alias("n_dup_lines"),
                   c["rep"].alias("n_repeat_words"), failed.alias("base_failed"), kept.alias("kept"),
                   left.cast("bigint").alias("n_kept_words")]
            if with_text:
                clean = F.when(F.size(bad) == 0, t).otherwise(
                    F.array_join(F.filter(lines, lambda x: ~F.array_contains(bad, x)), "\n"))
                out.append(F.when(kept, clean).alias("text"))
            return F.struct(*out)

        return let(counts, lambda c: let(text_flags(t), lambda flags: let(
            F.split(t, "\n"), lambda lines: of_lines(lines, c, flags))))

    return let(F.coalesce(text, F.lit("")), of_text)


def score_documents(docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_kept_words. Map-only."""
    d = pick(docs, doc_id=id_col, text=text_col)
    return (d.select(F.col("doc_id").alias(id_col), F.explode(F.array(judge(F.col("text"), rules, False))).alias("q"))
            .select(id_col, "q.*"))


def clean_documents(docs: DataFrame, rules: LineRules = LineRules(), text_col: str = "text") -> DataFrame:
    """The documents that pass, with their failing lines removed and all other columns
    as they are (``n_chars`` follows the text where the table has it). Map-only; the
    verdict is generated once a row, which no filter can duplicate."""
    cols = docs.columns
    passed = F.filter(F.array(judge(F.col(f"`{text_col}`"), rules, True)), lambda q: q["kept"])
    out = docs.select(*[F.col(f"`{c}`") for c in cols if c != text_col],
                      F.explode(F.transform(passed, lambda q: q["text"])).alias(text_col))
    return out.select(*[F.length(f"`{text_col}`").cast("bigint").alias(c) if c == "n_chars" else F.col(f"`{c}`")
                        for c in cols])


def _sql(max_symbol_words=0.3, bars=2, terminal=20, max_lost=0.5) -> str:
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT rid, doc_id, text, regexp_extract_all(text, '{word}') AS w,
        string_split(text, chr(10)) AS lines FROM d),
win AS (SELECT rid, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i+1, i+2]) AS p FROM rep) GROUP BY rid),
ln AS (SELECT rid, unnest(lines) AS l FROM t),
lf AS (SELECT rid, l, len(regexp_extract_all(l, '{word}')) AS n FROM ln),
lk AS (SELECT rid, l, n, NOT (
         (length(l) - length(replace(l, ' | ', '  '))) >= {bars}
         OR regexp_matches(lower(l), '{"|".join(BOILERPLATE)}')
         OR len(regexp_extract_all(l, '[#*$%&<>]\S*|[!?]{{2,}}')) > {max_symbol_words} * n
         OR (n >= {terminal} AND NOT regexp_matches(l, '[.!?…。]'))) AS ok FROM lf),
la AS (SELECT rid, (count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0)) AS dup,
         coalesce(sum(n) FILTER (ok), 0) AS kept FROM lk GROUP BY rid),
s AS (SELECT t.doc_id, len(t.w)::BIGINT AS n_words,
        length(translate(t.text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
        (length(t.text) - length(translate(t.text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
        la.dup::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, la.kept::BIGINT AS n_kept_words
      FROM t JOIN la USING (rid) LEFT JOIN cov USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_kept_words >= {1.0 - max_lost} * n_words) AS kept,
  n_kept_words
FROM s"""


SQL = _sql()
