"""Text normalisation as built-in Spark column expressions (no Python UDF).

T2 tokenise, T3 stop-word removal, T4 lower-case, T5 Porter stem,
T1 document text, T7 tagged-record text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import rules


def _sentence_breaks(s: Column) -> Column:
    for pat, rep in rules.TOKEN_RULES_BEFORE_PAD:
        s = F.regexp_replace(s, rules.SPARK_PATTERNS.get(pat, pat), rules.spark_replacement(rep))
    return s


def tokens(text: Column | str) -> Column:
    """ARRAY<STRING> of word and punctuation tokens, in text order."""
    s = F.col(text) if isinstance(text, str) else text
    return _padded_tokens(F.concat(F.lit(" "), F.regexp_replace(_sentence_breaks(s), rules.SPARK_WHITE_BUT_BLANK, " "), F.lit(" ")))


def words(text: Column | str) -> Column:
    """ARRAY<STRING> of what white space separates once sentence ends are marked, with empty strings
    between white space.  ``tokens(text)`` is the ``word_tokens`` of these words in order: after the padding,
    a rule looks at one word and the blanks at its ends only."""
    s = F.col(text) if isinstance(text, str) else text
    return F.split(F.regexp_replace(_sentence_breaks(s), rules.SPARK_WHITE_BUT_BLANK, " "), " ")


def word_tokens(word: Column | str) -> Column:
    """ARRAY<STRING> of the tokens of one of the ``words``; a word without a letter of any rule is its own token."""
    w = F.col(word) if isinstance(word, str) else word
    padded = _padded_tokens(F.concat(F.lit(" "), w, F.lit(" ")))
    return F.when(w.rlike(rules.SPARK_SPLIT_IN_WORD), padded).otherwise(F.array(w))


def _padded_tokens(s: Column) -> Column:
    for pat, rep in rules.TOKEN_RULES_AFTER_PAD:
        if pat == '"':  # a letter for a text: no regex is needed
            s = F.replace(s, F.lit(pat), F.lit(*rep))
        else:
            s = F.regexp_replace(s, rules.SPARK_PATTERNS.get(pat, pat), rules.spark_replacement(rep))
    # blanks are the only white space by now; no rule tells one from several
    return F.array_remove(F.split(s, " "), "")


def default_stopwords() -> list[str]:
    return list(rules.NLTK_ENGLISH_STOPWORDS)


def is_stopword(tok: Column, stopwords: list[str] | None = None) -> Column:
    """Case-sensitive membership test; Catalyst turns the literal list
    into a hash set (InSet), so the cost per token does not grow with it."""
    words = default_stopwords() if stopwords is None else list(stopwords)
    if not words:
        return F.lit(False)
    return tok.isin(words)


def stem_expr(src: str, mode: str = "porter") -> Column:
    """T5: Porter stem of column ``src`` (lower-case input).

    Each step is a lambda over the value of the step before, so every step reads it
    exactly once: the nested expression grows linearly and
    stays linear when the optimizer inlines it into pushed-down filters or
    join keys (a plain chain of projections would be copied per reference).
    The steps are interpreted, so words that end in no suffix of any step leave before the first, and
    steps whose suffixes a word does not have are passed over. The value is bound as the start of an
    `aggregate` over one constant entry, which makes no array for each word.
    """
    n = len(rules.porter_stages("spark", "w", mode))

    def step(k: int, w: str) -> str:
        return rules.porter_stages("spark", w, mode)[k]

    def bind(value: str, w: str, body: str) -> str:
        return f"aggregate(array(0), {value}, ({w}, i) -> {body})"

    two = ", ".join(rules.sql_str(x) for x in rules.PORTER_STEPS_2_TO_4_LAST_TWO)
    inner = step(4, "w")  # steps 1c, 2, 3 and 4
    for k in range(5, n - 3):
        inner = bind(inner, "x", step(k, "x"))
    e = bind(step(0, src), "w", f"IF(w LIKE '%s', {step(1, 'w')}, w)")
    e = bind(e, "w", f"IF(w LIKE '%ed' OR w LIKE '%ing' OR w LIKE '% ', {bind(step(2, 'w'), 'x', step(3, 'x'))}, w)")
    e = bind(e, "w", f"IF(w LIKE '%y' OR right(w, 2) IN ({two}), {inner}, w)")
    e = bind(e, "w", f"IF(w LIKE '%e', {bind(step(n - 3, 'w'), 'x', step(n - 2, 'x'))}, {step(n - 2, 'w')})")
    e = bind(e, "w", step(n - 1, "w"))
    return F.expr(rules.irregular_case(src, f"CASE WHEN {rules.unchanged(src)} THEN {src} ELSE {e} END", mode))


def stem_column(df: DataFrame, src: str, dst: str = "term", mode: str = "porter") -> DataFrame:
    """T5 applied to a DataFrame column (``mode``: "porter" or "nltk")."""
    return df.withColumn(dst, stem_expr(src, mode))


def doc_text(cols: list[str], null_token: str | None = "nan") -> Column:
    """`` " " + c1 + " " + c2 ...``; a null renders as ``null_token``
    (the string ``nan`` by default, as ``str()`` of a missing value)."""
    parts = []
    for c in cols:
        parts.append(F.coalesce(F.col(c).cast("string"), F.lit(null_token)) if null_token is not None
                     else F.col(c).cast("string"))
    return F.concat_ws(" ", F.lit(""), *parts)


def record_text(text: Column, keep_markers: bool = False) -> Column:
    """Text of a tagged record; lines holding only a section marker
    (``.T``, ``.W``, ...) are dropped unless ``keep_markers``."""
    if keep_markers:
        return text
    return F.regexp_replace(text, r"(?m)^\.[A-Z][ \t]*$", "")
