"""Pinned text rules: tokeniser, stop words and Porter stemmer.

Each rule is stated once here and rendered for two SQL dialects: Spark
(through the Column API or ``F.expr``) and DuckDB (the test oracle).  The
relational parts of the jobs are written separately in each engine; only
these rule tables are shared, so both engines tokenise and stem alike.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# The English stop-word list of NLTK (corpus "stopwords",
# file "english", 179 words), in the order of that file.  The filter is
# case-sensitive and runs before lower-casing.
# ---------------------------------------------------------------------------
NLTK_ENGLISH_STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd "
    "your yours yourself yourselves he him his himself she she's her hers "
    "herself it it's its itself they them their theirs themselves what which "
    "who whom this that that'll these those am is are was were be been being "
    "have has had having do does did doing a an the and but if or because as "
    "until while of at by for with about against between into through during "
    "before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few "
    "more most other some such no nor not only own same so than too very s t "
    "can will just don don't should should've now d ll m o re ve y ain aren "
    "aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't "
    "haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't "
    "shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn "
    "wouldn't"
).split()

# ---------------------------------------------------------------------------
# Tokeniser v1: a regex rendering of Treebank-style word splitting.
# A replacement is a list of parts: int = capture group, str = literal text.
# Patterns use no look-around and no back-references, so both Java regex
# (Spark) and RE2 (DuckDB) accept them.
# ---------------------------------------------------------------------------
TOKEN_RULES_BEFORE_PAD = [
    # sentence break: end punctuation followed by white space -> new line
    (r"([.!?])\s+", [1, "\n"]),
    # a full stop that ends a line (after optional closing brackets/quotes)
    (r"""([^.])([.])([\])}>"' ]*)\s*(\n|$)""", [1, " ", 2, " ", 3, " ", 4]),
]
# between the two lists: collapse white space to one blank, pad both ends
TOKEN_RULES_AFTER_PAD = [
    # colon / comma unless followed by a digit (1,000 and 12:30 stay whole)
    (r"([:,])([^0-9])", [" ", 1, " ", 2]),
    # other punctuation, ellipses and double dashes are their own tokens
    (r"([;@#$%&?!*()\[\]{}<>]|\.\.+|--)", [" ", 1, " "]),
    # an opening double quote (after a blank or an opening bracket) becomes
    # the token ``, any other double quote the token ''
    (r"""([ (\[{<])("|'')""", [1, " `` "]),
    (r'"', [" '' "]),
    # contractions, and a bare trailing apostrophe, split off the word they end
    (r"([^' ])((?i:'ll|'re|'ve|n't|'s|'m|'d)|') ", [1, " ", 2, " "]),
]
WHITESPACE = r"\s+"
# Java renderings of single rules, equal in what they match: a look-ahead at one character rules out
# most places before the alternatives are tried (RE2 needs no such help and has no look-ahead)
SPARK_PATTERNS = {
    r"([;@#$%&?!*()\[\]{}<>]|\.\.+|--)": r"(?=[;@#$%&?!*()\[\]{}<>.\-])([;@#$%&?!*()\[\]{}<>]|\.\.+|--)",
    r"([^' ])((?i:'ll|'re|'ve|n't|'s|'m|'d)|') ": r"([^' ])(?=['nN])((?i:'ll|'re|'ve|n't|'s|'m|'d)|') ",
}

# what WHITESPACE matches in Java, one character at a time and without the blank
SPARK_WHITE_BUT_BLANK = r"[\t-\r]"
# every match of a rule after the padding has one of these in it: a word without any is one token
SPARK_SPLIT_IN_WORD = r"""[:,;@#$%&?!*()\[\]{}<>"'.\-]"""

# ---------------------------------------------------------------------------
# Porter (1980) suffix rules, in the order of the paper.
# (suffix, replacement, condition on the remaining stem)
# ---------------------------------------------------------------------------
PORTER_STEP1A = [("sses", "ss", None), ("ies", "i", None), ("ss", "ss", None), ("s", "", None)]
# a blank marks a removed -ed/-ing (no token holds one); the step-1b fix-up rules resolve the mark
PORTER_STEP1B = [("eed", "ee", "m>0"), ("ed", " ", "*v*"), ("ing", " ", "*v*")]
PORTER_STEP1B_ADD_E = ["at", "bl", "iz"]
PORTER_STEP1C = [("y", "i", "*v*")]
PORTER_STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
PORTER_STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
PORTER_STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]
# A word that is not changed by any rule, told by its last letters: none of these ends (the last one or
# two letters of all suffixes above and of the NLTK variant, and the mark of step 1b) and no leading "Y".
PORTER_LAST_LETTER = "sye "
PORTER_LAST_TWO = "ed ng al ci er li gi on or sm ti ul ic nt ou ll".split()
# the last two letters of all suffixes of steps 2 to 4, those of the NLTK variant included
PORTER_STEPS_2_TO_4_LAST_TWO = sorted({x[-2:] for x in [
    *(a for a, _ in PORTER_STEP2 + PORTER_STEP3), *PORTER_STEP4, "bli", "fulli", "logi"]})
# consonant pairs that step 1b reduces to one letter (all but l, s, z)
PORTER_DOUBLE_REDUCE = ["bb", "cc", "dd", "ff", "gg", "hh", "jj", "kk", "mm",
                        "nn", "pp", "qq", "rr", "tt", "vv", "ww", "xx"]

# ---------------------------------------------------------------------------
# The additions of NLTK's default Porter variant (used by the
# reference), selectable with mode="nltk".  Irregular forms, in NLTK's order:
# result <- surface words.
# ---------------------------------------------------------------------------
NLTK_IRREGULAR_FORMS = {
    "sky": ["sky", "skies"],
    "die": ["dying"],
    "lie": ["lying"],
    "tie": ["tying"],
    "news": ["news"],
    "inning": ["innings", "inning"],
    "outing": ["outings", "outing"],
    "canning": ["cannings", "canning"],
    "howe": ["howe"],
    "proceed": ["proceed"],
    "exceed": ["exceed"],
    "succeed": ["succeed"],
}
# step 2 in the NLTK variant: "bli" -> "ble" replaces "abli" -> "able", and
# two rules are added; "logi" tests the measure of the stem that keeps its "l"
NLTK_STEP2_REPLACED = ("abli", "able")
NLTK_STEP2_INSTEAD = ("bli", "ble")

# Measure tests as regexes over the stem.  C = consonant run, V = vowel run;
# "y" after a consonant is a vowel.  A leading "y" is written "Y" during
# stemming so that it always counts as a consonant.
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
MEASURE_REGEX = {
    "m>0": f"^({_C})?{_V}{_C}",
    "m=1": f"^({_C})?{_V}{_C}({_V})?$",
    "m>1": f"^({_C})?{_V}{_C}{_V}{_C}",
    "*v*": f"^({_C})?[aeiouy]",
    # ends consonant-vowel-consonant, last not w/x/y, with m = 1
    "*o": "^[^aeiou][^aeiouy]*[aeiouy][^aeiouwxy]$",
    # NLTK variant: a two-letter vowel-consonant stem also counts as *o
    "*o2": "^[aeiou][^aeiou]$",
    # NLTK variant of step 1c: the stem ends with a consonant
    "*c": "([^aeiouy]|[aeiou]y)$",
}


# ---------------------------------------------------------------------------
# dialect rendering
# ---------------------------------------------------------------------------
def sql_str(s: str) -> str:
    """SQL string literal (no backslash escapes needed in either use)."""
    return "'" + s.replace("'", "''") + "'"


def spark_replacement(parts) -> str:
    """Java regex replacement string."""
    out = []
    for p in parts:
        out.append(f"${p}" if isinstance(p, int) else p.replace("\\", "\\\\").replace("$", "\\$"))
    return "".join(out)


def duckdb_replacement(parts) -> str:
    """RE2 replacement as a DuckDB SQL expression (new lines via chr(10))."""
    pieces = []
    for p in parts:
        if isinstance(p, int):
            pieces.append(sql_str(f"\\{p}"))
        else:
            chunks = p.split("\n")
            for i, c in enumerate(chunks):
                if i:
                    pieces.append("chr(10)")
                if c:
                    pieces.append(sql_str(c.replace("\\", "\\\\")))
    return " || ".join(pieces) if pieces else "''"


def duckdb_tokens_sql(text_expr: str) -> str:
    """DuckDB expression: LIST of tokens of ``text_expr`` (tokeniser v1)."""
    s = text_expr
    for pat, rep in TOKEN_RULES_BEFORE_PAD:
        s = f"regexp_replace({s}, {sql_str(pat)}, {duckdb_replacement(rep)}, 'g')"
    s = f"(' ' || regexp_replace({s}, {sql_str(WHITESPACE)}, ' ', 'g') || ' ')"
    for pat, rep in TOKEN_RULES_AFTER_PAD:
        s = f"regexp_replace({s}, {sql_str(pat)}, {duckdb_replacement(rep)}, 'g')"
    return f"list_filter(string_split_regex({s}, {sql_str(WHITESPACE)}), lambda x: x <> '')"


def _match(expr: str, regex: str, dialect: str) -> str:
    if dialect == "spark":
        return f"({expr} RLIKE {sql_str(regex)})"
    return f"regexp_matches({expr}, {sql_str(regex)})"


def _cond(cond: str | None, stem: str, dialect: str, nltk: bool = False) -> str:
    if cond is None:
        return "TRUE"
    if cond == "*o" and nltk:
        return (f"({_match(stem, MEASURE_REGEX['*o'], dialect)} OR "
                f"{_match(stem, MEASURE_REGEX['*o2'], dialect)})")
    if cond == "*c and len>1":
        return f"(length({stem}) > 1 AND {_match(stem, MEASURE_REGEX['*c'], dialect)})"
    if cond == "m>1 and (*S or *T)":
        return (f"({_match(stem, MEASURE_REGEX['m>1'], dialect)} AND "
                f"({stem} LIKE '%s' OR {stem} LIKE '%t'))")
    if cond == "m=1 and *o":
        return (f"({_match(stem, MEASURE_REGEX['m=1'], dialect)} AND "
                f"{_cond('*o', stem, dialect, nltk)})")
    return _match(stem, MEASURE_REGEX[cond], dialect)


def _strip(w: str, n: int) -> str:
    return f"left({w}, length({w}) - {n})"


def _choose(branches, otherwise: str, dialect: str) -> str:
    """The value of the first (condition, value) that holds.  Spark interprets the stem rules, and its CASE counts
    the list of branches for each row, so IFs are nested there."""
    if dialect == "spark":
        for cond, value in reversed(branches):
            otherwise = f"IF({cond}, {value}, {otherwise})"
        return otherwise
    return "CASE " + " ".join(f"WHEN {cond} THEN {value}" for cond, value in branches) + f" ELSE {otherwise} END"


def _suffix_case(w: str, rules, dialect: str) -> str:
    """One Porter step: the longest matching suffix decides, even when its
    condition then fails (the word is kept unchanged in that case).  For Spark, whose stages are
    interpreted, long lists are looked through by the last letter first."""
    ordered = sorted(rules, key=lambda r: -len(r[0]))
    if dialect == "spark" and len(rules) > 4:
        last = dict.fromkeys(r[0][-1] for r in ordered)
        groups = [(c, [r for r in ordered if r[0][-1] == c]) for c in last]
        if len(groups) > 1:
            return _choose([(f"{w} LIKE '%{c}'", _suffix_branches(w, g, dialect)) for c, g in groups], w, dialect)
    return _suffix_branches(w, ordered, dialect)


def _suffix_branches(w: str, ordered, dialect: str) -> str:
    branches = []
    for suffix, rep, cond, *cond_strip in ordered:
        stem = _strip(w, len(suffix))
        new = f"concat({stem}, {sql_str(rep)})" if rep else stem
        if cond is None:
            branches.append((f"{w} LIKE '%{suffix}'", new))
        else:
            tested = _strip(w, cond_strip[0]) if cond_strip else stem
            branches.append((f"{w} LIKE '%{suffix}'", _choose([(_cond(cond, tested, dialect), new)], w, dialect)))
    return _choose(branches, w, dialect)


def porter_stages(dialect: str, w: str = "w", mode: str = "porter") -> list[str]:
    """SQL expressions, each rewriting column ``w`` from the previous stage.

    ``mode="porter"``: the rules of the 1980 paper.  ``mode="nltk"``: with
    the additions of NLTK's default variant (short ``ies``/``ied`` words,
    step 1c only after a consonant, ``alli`` first, ``bli``/``fulli``/``logi``,
    two-letter *o); irregular forms are applied by the caller
    (:func:`irregular_case`).  Every stage reads ``w`` many times, so the
    stages must not be folded into one expression by plain substitution.
    """
    if mode not in ("porter", "nltk"):
        raise ValueError(f"unknown stemmer mode {mode!r}")
    nltk = mode == "nltk"
    stages = []
    # mark a leading y as consonant
    stages.append(_choose([(f"{w} LIKE 'y%'", f"concat('Y', substr({w}, 2))")], w, dialect))
    step1a = _suffix_case(w, PORTER_STEP1A, dialect)
    if nltk:
        step1a = _choose([(f"{w} LIKE '%ies' AND length({w}) = 4", f"concat({_strip(w, 3)}, 'ie')")], step1a, dialect)
    stages.append(step1a)
    step1b = _suffix_case(w, PORTER_STEP1B, dialect)
    if nltk:
        ending = _choose([(f"length({w}) = 4", "'ie'")], "'i'", dialect)
        step1b = _choose([(f"{w} LIKE '%ied'", f"concat({_strip(w, 3)}, {ending})")], step1b, dialect)
    stages.append(step1b)
    s = _strip(w, 1)
    add_e = " OR ".join(f"{s} LIKE '%{x}'" for x in PORTER_STEP1B_ADD_E)
    dbl = "(" + "|".join(PORTER_DOUBLE_REDUCE) + ")$"
    stages.append(_choose([
        (f"{w} NOT LIKE '% '", w), (add_e, f"concat({s}, 'e')"), (_match(s, dbl, dialect), _strip(s, 1)),
        (_cond("m=1 and *o", s, dialect, nltk), f"concat({s}, 'e')")], s, dialect))
    step1c = [(a, b, "*c and len>1") for a, b, _ in PORTER_STEP1C] if nltk else PORTER_STEP1C
    stages.append(_suffix_case(w, step1c, dialect))
    step2 = [(a, b, "m>0") for a, b in PORTER_STEP2]
    if nltk:
        stages.append(_choose([(f"{w} LIKE '%alli' AND {_cond('m>0', _strip(w, 4), dialect)}",
                                f"concat({_strip(w, 4)}, 'al')")], w, dialect))
        step2 = [(*NLTK_STEP2_INSTEAD, "m>0") if (a, b) == NLTK_STEP2_REPLACED else (a, b, c)
                 for a, b, c in step2]
        step2 += [("fulli", "ful", "m>0"), ("logi", "log", "m>0", 3)]
    stages.append(_suffix_case(w, step2, dialect))
    stages.append(_suffix_case(w, [(a, b, "m>0") for a, b in PORTER_STEP3], dialect))
    stages.append(_suffix_case(
        w, [(a, "", "m>1 and (*S or *T)" if a == "ion" else "m>1") for a in PORTER_STEP4], dialect))
    s = _strip(w, 1)
    stages.append(_choose([(f"{w} LIKE '%e' AND ({_cond('m>1', s, dialect)} OR "
                            f"({_cond('m=1', s, dialect)} AND NOT {_cond('*o', s, dialect, nltk)}))", s)], w, dialect))
    stages.append(_choose([(f"{w} LIKE '%ll' AND {_cond('m>1', w, dialect)}", _strip(w, 1))], w, dialect))
    stages.append(_choose([(f"{w} LIKE 'Y%'", f"concat('y', substr({w}, 2))")], w, dialect))
    return stages


def unchanged(surface: str) -> str:
    """Spark condition: no rule of either variant changes the word (false for some words that none changes)."""
    one = ", ".join(sql_str(x) for x in PORTER_LAST_LETTER)
    two = ", ".join(sql_str(x) for x in PORTER_LAST_TWO)
    return f"{surface} NOT LIKE 'Y%' AND right({surface}, 1) NOT IN ({one}) AND right({surface}, 2) NOT IN ({two})"


def irregular_case(surface: str, stemmed: str, mode: str) -> str:
    """Final choice: short words pass through; NLTK irregular forms map directly."""
    branches = [f"WHEN length({surface}) <= 2 THEN {surface}"]
    if mode == "nltk":
        for result, forms in NLTK_IRREGULAR_FORMS.items():
            words = ", ".join(sql_str(f) for f in forms)
            branches.append(f"WHEN {surface} IN ({words}) THEN {sql_str(result)}")
    return "CASE " + " ".join(branches) + f" ELSE {stemmed} END"


def duckdb_stem_ctes(source: str, col: str, prefix: str = "stem",
                     mode: str = "porter") -> tuple[str, str]:
    """CTE text that stems the distinct values of ``source.col``.

    Returns (ctes, final_cte_name); the final CTE has columns (surface, term).
    Words of two characters or fewer pass through unchanged.
    """
    stages = porter_stages("duckdb", mode=mode)
    parts = [f"{prefix}0 AS (SELECT DISTINCT {col} AS surface, {col} AS w FROM {source})"]
    for i, st in enumerate(stages, start=1):
        parts.append(f"{prefix}{i} AS (SELECT surface, {st} AS w FROM {prefix}{i - 1})")
    n = len(stages)
    parts.append(
        f"{prefix} AS (SELECT surface, {irregular_case('surface', 'w', mode)} AS term FROM {prefix}{n})")
    return ",\n".join(parts), prefix


def duckdb_stopword_list() -> str:
    return "(" + ", ".join(sql_str(w) for w in NLTK_ENGLISH_STOPWORDS) + ")"
