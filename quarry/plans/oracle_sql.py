"""DuckDB SQL for every registered query (the correctness oracle).

Only the pinned text rules (token regexes, stop words, stem cases) are
rendered from ``quarry.functions.rules``; joins, aggregates and rankings are
written here by hand, independently of the Spark code.  Every double is
rounded to 6 digits and every integer cast to BIGINT on both sides.
"""

from __future__ import annotations

from quarry.functions import rules

STOP = rules.duckdb_stopword_list()


def tokens_cte(name: str, source: str, id_expr: str, text_expr: str, stop: bool = True) -> str:
    """(id, pos, surface): tokens, stop words dropped (case-sensitive), lower-cased."""
    toks = rules.duckdb_tokens_sql(text_expr)
    where = f"WHERE tok NOT IN {STOP}" if stop else ""
    return (f"{name}_raw AS (SELECT {id_expr} AS id, {toks} AS toks FROM {source}),\n"
            f"{name}_tok AS (SELECT id, unnest(toks) AS tok, "
            f"CAST(generate_subscripts(toks, 1) - 1 AS BIGINT) AS pos FROM {name}_raw),\n"
            f"{name} AS (SELECT id, pos, lower(tok) AS surface FROM {name}_tok {where})")


def stem_ctes(surface_sources: list[str], name: str = "stem", mode: str = "porter") -> str:
    """(surface, term) for the distinct surfaces of the given CTEs."""
    union = " UNION ".join(f"SELECT surface FROM {s}" for s in surface_sources)
    ctes, _ = rules.duckdb_stem_ctes(f"({union})", "surface", name, mode)
    return ctes


def index_ctes(docs_source: str = "documents", id_expr: str = "doc_id",
               text_expr: str = "text", mode: str = "porter") -> str:
    """dtok, stem, doc_terms, post, ndocs, stats, wts, dnorm over a document table."""
    return ",\n".join([
        tokens_cte("dtok", docs_source, id_expr, text_expr),
        stem_ctes(["dtok"], mode=mode),
        "doc_terms AS (SELECT t.id AS doc_id, t.pos, s.term FROM dtok t JOIN stem s ON t.surface = s.surface)",
        "post AS (SELECT term, doc_id, count(*) AS tf FROM doc_terms GROUP BY term, doc_id)",
        f"ndocs AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {docs_source})",
        "stats AS (SELECT p.term, count(*) AS df, CAST(sum(p.tf) AS BIGINT) AS cf, "
        "log2(max(ndocs.n) / count(*)) AS idf FROM post p, ndocs GROUP BY p.term)",
        "wts AS (SELECT p.term, p.doc_id, p.tf, p.tf * s.idf AS w FROM post p JOIN stats s ON p.term = s.term)",
        f"dnorm AS (SELECT d.{id_expr} AS doc_id, coalesce(sqrt(sum(w.w * w.w)), 0.0) AS norm "
        f"FROM {docs_source} d LEFT JOIN wts w ON w.doc_id = d.{id_expr} GROUP BY d.{id_expr})",
    ])


def query_ctes(query_source: str = "benchmark", id_expr: str = "item_id",
               text_expr: str = "text", synonyms: bool = False, mode: str = "porter") -> str:
    """qtok..., qterms(query_id, pos, term).  With ``synonyms``: the synonym
    table maps each corpus surface word to its stem (when different); a
    query token gains that lemma unless the query already holds it."""
    tok = tokens_cte("qtok", query_source, id_expr, text_expr)
    if not synonyms:
        return ",\n".join([
            tok, stem_ctes(["qtok"], "qstem", mode),
            "qterms AS (SELECT t.id AS query_id, t.pos, s.term FROM qtok t JOIN qstem s ON t.surface = s.surface)",
        ])
    return ",\n".join([
        tok,
        "syn AS (SELECT surface AS word, term AS lemma FROM stem WHERE term <> surface)",
        f"qkept AS (SELECT id, pos, tok FROM qtok_tok WHERE tok NOT IN {STOP})",
        "found AS (SELECT q.id AS query_id, q.pos, s.lemma AS tok FROM qkept q JOIN syn s ON lower(q.tok) = s.word)",
        "fresh AS (SELECT f.* FROM found f WHERE NOT EXISTS "
        "(SELECT 1 FROM qkept o WHERE o.id = f.query_id AND o.tok = f.tok))",
        "qall AS (SELECT id AS query_id, pos, lower(tok) AS surface FROM qkept "
        "UNION ALL SELECT query_id, pos, lower(tok) AS surface FROM fresh)",
        stem_ctes(["qall"], "qstem", mode),
        "qterms AS (SELECT t.query_id, t.pos, s.term FROM qall t JOIN qstem s ON t.surface = s.surface)",
    ])


def score_ctes(k: int = 10) -> str:
    return ",\n".join([
        "qtf AS (SELECT query_id, term, count(*) AS qtf FROM qterms GROUP BY query_id, term)",
        "qw AS (SELECT q.query_id, q.term, q.qtf, q.qtf * s.idf AS qw FROM qtf q JOIN stats s ON q.term = s.term)",
        "qnorm AS (SELECT query_id, sqrt(sum(qw * qw)) AS qnorm FROM qw GROUP BY query_id)",
        "dot AS (SELECT qw.query_id, w.doc_id, sum(qw.qw * w.w) AS dot FROM qw JOIN wts w ON qw.term = w.term "
        "GROUP BY qw.query_id, w.doc_id)",
        "scored AS (SELECT d.query_id, d.doc_id, round(CASE WHEN n.norm * q.qnorm = 0 THEN NULL "
        "ELSE d.dot / (n.norm * q.qnorm) END, 6) AS score FROM dot d "
        "JOIN dnorm n ON d.doc_id = n.doc_id JOIN qnorm q ON d.query_id = q.query_id)",
        "ranked AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id "
        "ORDER BY score DESC NULLS LAST, doc_id) AS rank FROM scored)",
        f"top AS (SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, score FROM ranked WHERE rank <= {k})",
    ])


def index_only(select: str) -> str:
    return "WITH " + index_ctes() + "\n" + select


def full(select: str, k: int = 10, extra: str | None = None, mode: str = "porter", **qkw) -> str:
    parts = [index_ctes(mode=mode), query_ctes(mode=mode, **qkw), score_ctes(k)]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n" + select


def _docs_only(select: str, stop: bool = True) -> str:
    return "WITH " + tokens_cte("dtok", "documents", "doc_id", "text", stop) + "\n" + select


ORACLE: dict[str, str] = {}

ORACLE["search_top10"] = full("SELECT query_id, rank, doc_id, score FROM top")
# pruning must not change a single row
ORACLE["search_top10_pruned"] = ORACLE["search_top10"]
# the same search with NLTK's Porter variant (the reference's stemmer)
ORACLE["search_top10_nltk"] = full("SELECT query_id, rank, doc_id, score FROM top", mode="nltk")

ORACLE["tokenize"] = (
    "WITH raw AS (SELECT doc_id, " + rules.duckdb_tokens_sql("text") + " AS toks FROM documents)\n"
    "SELECT doc_id, CAST(generate_subscripts(toks, 1) - 1 AS BIGINT) AS pos, unnest(toks) AS tok FROM raw")

_ABBREVIATIONS = r"""
chunk AS (SELECT unnest(string_split_regex(text, '\s+')) AS c FROM documents),
opened AS (SELECT regexp_extract(c, '^[(\[{<"''`]*(\p{L}(?:[\p{L}.]*\p{L})?)(\.*)', ['word', 'stops']) AS m FROM chunk),
counted AS (SELECT lower(m.word) AS word, count(*) FILTER (m.stops = '.') AS n_stop, count(*) FILTER (m.stops <> '.') AS n_plain
  FROM opened WHERE m.word <> '' GROUP BY 1),
rate AS (SELECT sum(n_stop) / sum(n_stop + n_plain) AS p FROM counted),
abbr_scored AS (SELECT word, n_stop, n_plain, length(replace(word, '.', '')) AS letters, length(word) AS l,
  2 * (n_stop * ln(0.99 / p) + n_plain * ln((1 - 0.99) / nullif(1 - p, 0))) AS gain FROM counted, rate WHERE n_stop > 0),
abbr AS (SELECT word, n_stop, n_plain, gain * (l - letters + 1) * exp(-(letters + n_plain * ln(letters))) AS score
  FROM abbr_scored WHERE gain * (l - letters + 1) * exp(-(letters + n_plain * ln(letters))) >= 0.3)"""

ORACLE["abbreviations"] = "WITH " + _ABBREVIATIONS + "\nSELECT word, n_stop, n_plain, round(score, 6) AS score FROM abbr"

ORACLE["tokenize_learned"] = (
    "WITH " + _ABBREVIATIONS + r""",
cut AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '\s+$', ''), '([.!?])\s+', '\1' || chr(10), 'g'), chr(10)) AS ps FROM documents),
piece AS (SELECT doc_id, len(ps) AS n, generate_subscripts(ps, 1) AS nr, unnest(ps) AS piece FROM cut),
judged AS (SELECT *, nr < n AND lower(regexp_extract(piece, '(?:^|[^\p{L}\p{N}.])(\p{L}(?:[\p{L}.]*\p{L})?)\.\z', 1)) IN (SELECT word FROM abbr) AS goes_on
  FROM piece),
split AS (SELECT doc_id, nr, goes_on, """ + rules.duckdb_tokens_sql("(CASE WHEN goes_on THEN left(piece, length(piece) - 1) ELSE piece END)") + r""" AS t FROM judged),
glued AS (SELECT doc_id, nr, CASE WHEN goes_on THEN list_concat(t[:-2], [t[-1] || '.']) ELSE t END AS t FROM split),
placed AS (SELECT doc_id, t, coalesce(sum(len(t)) OVER (PARTITION BY doc_id ORDER BY nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM glued)
SELECT doc_id, CAST(s + generate_subscripts(t, 1) - 1 AS BIGINT) AS pos, unnest(t) AS tok FROM placed""")

ORACLE["remove_stopwords"] = (
    "WITH raw AS (SELECT doc_id, " + rules.duckdb_tokens_sql("text") + " AS toks FROM documents),\n"
    "t AS (SELECT doc_id, CAST(generate_subscripts(toks, 1) - 1 AS BIGINT) AS pos, unnest(toks) AS tok FROM raw)\n"
    f"SELECT doc_id, pos, tok FROM t WHERE tok NOT IN {STOP}")

ORACLE["normalized_terms"] = index_only("SELECT doc_id, pos, term FROM doc_terms")

ORACLE["stem_vocabulary"] = _docs_only(
    ",\n" + stem_ctes(["dtok"]) + "\nSELECT surface, term FROM stem").replace("\n,\n", ",\n", 1)

ORACLE["stem_dictionary"] = _docs_only(
    ",\n" + stem_ctes(["dtok"]) + "\nSELECT s.surface, s.term, count(*) AS n FROM dtok t JOIN stem s ON t.surface = s.surface "
    "GROUP BY s.surface, s.term").replace("\n,\n", ",\n", 1)

ORACLE["vocabulary"] = index_only(
    ", firsts AS (SELECT term, arg_min(doc_id, doc_id * 1000000000 + pos) AS first_doc_id, "
    "min(doc_id * 1000000000 + pos) AS k FROM doc_terms GROUP BY term)\n"
    "SELECT f.term, CAST(row_number() OVER (ORDER BY f.k) - 1 AS BIGINT) AS term_id, f.first_doc_id, "
    "CAST(f.k - f.first_doc_id * 1000000000 AS BIGINT) AS first_pos FROM firsts f").replace(
        "\n, firsts", ",\nfirsts", 1)

ORACLE["postings"] = index_only("SELECT term, doc_id, tf FROM post")
# a stored stem must not change a single row
ORACLE["postings_by_dictionary"] = ORACLE["postings"]
ORACLE["term_stats"] = index_only("SELECT term, df, cf FROM stats")
ORACLE["term_idf"] = index_only("SELECT term, df, round(idf, 6) AS idf FROM stats")
ORACLE["tfidf_weights"] = index_only("SELECT term, doc_id, tf, round(w, 6) AS w FROM wts")
ORACLE["sparse_matrix"] = index_only("SELECT term, doc_id, round(w, 6) AS w FROM wts WHERE w <> 0")
ORACLE["doc_norms"] = index_only("SELECT doc_id, round(norm, 6) AS norm FROM dnorm")
ORACLE["inverted_index"] = index_only(
    "SELECT p.term, s.df, s.cf, p.doc_id, p.tf FROM post p JOIN stats s ON p.term = s.term")

ORACLE["normalized_queries"] = full("SELECT query_id, pos, term FROM qterms")
ORACLE["query_weights"] = full("SELECT query_id, term, qtf, round(qw, 6) AS qw FROM qw")
ORACLE["query_norms"] = full("SELECT query_id, round(qnorm, 6) AS qnorm FROM qnorm")
ORACLE["candidate_docs"] = full(
    "SELECT DISTINCT q.query_id, p.doc_id FROM qterms q JOIN post p ON q.term = p.term")
ORACLE["cosine_scores"] = full("SELECT query_id, doc_id, score FROM scored")

# --- cleaning ---------------------------------------------------------------
ORACLE["dedup_keep_last"] = (
    "SELECT p_partkey, p_name, p_brand, p_type FROM (SELECT *, row_number() OVER "
    "(PARTITION BY p_name ORDER BY p_partkey DESC) AS rn FROM part) WHERE rn = 1")

ORACLE["dedup_chained"] = (
    "WITH a AS (SELECT * FROM (SELECT doc_id, lang, n_chars, source, text, row_number() OVER "
    "(PARTITION BY lang, n_chars ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn = 1)\n"
    "SELECT doc_id, lang, n_chars, source FROM (SELECT *, row_number() OVER "
    "(PARTITION BY text ORDER BY doc_id DESC) AS rn2 FROM a) WHERE rn2 = 1")

ORACLE["drop_null_rows"] = (
    "SELECT doc_id, source, name FROM (SELECT doc_id, source, nullif(lang, 'fr') AS name, "
    "row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS rn FROM documents) "
    "WHERE rn = 1 AND name IS NOT NULL")

_CLEAN_CTES = """cat AS (SELECT source || '/' || lang AS url, nullif(lang, 'es') AS name, source AS categories,
                    lang AS developer, CAST(n_chars AS VARCHAR) AS publisher, doc_id AS row_seq
             FROM documents),
cat1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY row_seq DESC) AS rn
                        FROM cat) WHERE rn = 1 AND name IS NOT NULL),
des AS (SELECT d.source || '/' || d.lang AS url, d.text AS "desc",
               CASE WHEN l.toxic = 1 THEN NULL ELSE d.text END AS full_desc, d.doc_id AS row_seq
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
des1 AS (SELECT url, "desc", full_desc, row_seq FROM (SELECT *, row_number() OVER
         (PARTITION BY url ORDER BY row_seq DESC) AS rn FROM des) WHERE rn = 1),
des2 AS (SELECT url, "desc" FROM (SELECT *, row_number() OVER
         (PARTITION BY "desc" ORDER BY row_seq DESC) AS rn FROM des1) WHERE rn = 1 AND full_desc IS NOT NULL),
m AS (SELECT c.url, c.name, c.categories, c.developer, c.publisher, d."desc", c.row_seq
      FROM cat1 c JOIN des2 d ON c.url IS NOT DISTINCT FROM d.url),
cleaned AS (SELECT CAST(row_number() OVER (ORDER BY row_seq) - 1 AS BIGINT) AS doc_id, url, name,
                   categories, developer, publisher, "desc" FROM m)"""

ORACLE["clean_catalog"] = ("WITH " + _CLEAN_CTES + "\nSELECT doc_id, url, name, categories, developer, "
                           "publisher, \"desc\" FROM cleaned")

ORACLE["doc_text"] = (
    "SELECT p_partkey, ' ' || p_name || ' ' || coalesce(nullif(p_type, 'SMALL'), 'nan') || ' ' || "
    "p_brand || ' ' || CAST(p_size AS VARCHAR) AS text FROM part")

ORACLE["tagged_sections"] = (
    "SELECT item_id AS query_id, text, CASE WHEN item_id % 3 <> 0 THEN 'Author ' || item_id END AS authors, "
    "' ' || item_id || '. remark' AS note FROM benchmark")
# the marker lines .T and .W leave empty lines
ORACLE["record_text"] = (
    "SELECT doc_id, 'Title ' || doc_id AS title, "
    "chr(10) || 'Title ' || doc_id || chr(10) || chr(10) || text || chr(10) AS text FROM documents")

# --- retrieval variants -----------------------------------------------------
ORACLE["synonym_expand"] = full("SELECT query_id, pos, term FROM qterms", synonyms=True)
ORACLE["search_synonyms"] = full("SELECT query_id, rank, doc_id, score FROM top", synonyms=True)

ORACLE["search_exhaustive"] = full(
    "SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, score FROM exr WHERE rank <= 10",
    extra="""allq AS (SELECT item_id AS query_id FROM benchmark),
ex AS (SELECT a.query_id, n.doc_id,
              round(CASE WHEN n.norm * coalesce(qn.qnorm, 0) = 0 THEN NULL
                         ELSE coalesce(dt.dot, 0) / (n.norm * qn.qnorm) END, 6) AS score
       FROM allq a CROSS JOIN dnorm n
       LEFT JOIN qnorm qn ON qn.query_id = a.query_id
       LEFT JOIN dot dt ON dt.query_id = a.query_id AND dt.doc_id = n.doc_id),
exr AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id
        ORDER BY score DESC NULLS LAST, doc_id) AS rank FROM ex)""")

_EVAL = """cnt AS (SELECT query_id, count(*) AS n FROM scored GROUP BY query_id),
evalcut AS (SELECT t.query_id, t.rank, t.doc_id, t.score FROM top t JOIN cnt c ON t.query_id = c.query_id
            WHERE t.rank <= CASE WHEN c.n >= 10 THEN 5 ELSE c.n END)"""
ORACLE["search_eval_cut"] = full("SELECT query_id, rank, doc_id, score FROM evalcut", extra=_EVAL)
ORACLE["search_labels"] = full(
    "SELECT e.query_id, e.rank, e.doc_id, e.score, concat_ws(' : ', CAST(e.doc_id AS VARCHAR), "
    "split_part(d.text, chr(10), 1)) AS label FROM evalcut e JOIN documents d ON e.doc_id = d.doc_id",
    extra=_EVAL)

_NAMEQ = ("(SELECT item_id AS qid, text AS p_name FROM benchmark UNION ALL "
          "SELECT -1 - min(p_partkey) AS qid, p_name FROM part GROUP BY p_name)")
ORACLE["search_status"] = full(
    "SELECT q.qid AS query_id, CAST(count(t.doc_id) AS BIGINT) AS n_hits, "
    "CASE WHEN count(t.doc_id) > 0 THEN 'found' ELSE 'no_result' END AS status "
    f"FROM {_NAMEQ} q LEFT JOIN top t ON t.query_id = q.qid GROUP BY q.qid",
    query_source=_NAMEQ, id_expr="qid", text_expr="p_name")

ORACLE["augmented_query"] = full(
    "SELECT query_id, rank, doc_id, score FROM top",
    text_expr="text || ' Singleplayer' || ' Online'")

ORACLE["search_with_attrs"] = full(
    "SELECT t.query_id, t.rank, t.doc_id, t.score, d.lang, d.source FROM top t "
    "JOIN documents d ON t.doc_id = d.doc_id")

# --- pages --------------------------------------------------------------------

_s = rules.sql_str


# Written for the given pages and independent of the engine's expressions: there every element in question is
# flat (text only), its attributes are in double quotes, and these references occur.
def _plain(x):
    return f"replace(replace(replace(replace({x}, '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


def _meta(attr, value, take, default="No description found"):
    v = '[^"]*' if value is None else value
    tag = f"regexp_extract(html, '<meta [^>]*{attr}=\"{v}\"[^>]*>', 0)"
    return f"coalesce(nullif({_plain(f"regexp_extract({tag}, ' {take}=\"([^\"]*)\"', 1)")}, ''), '{default}')"


def _links():
    return f"list_transform(regexp_extract_all(html, '<a [^>]*href=\"([^\"]*)\"', 1), lambda x: {_plain('x')})"


def _strip_ws(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _text(cls, default, strip=True):
    pat = f"'<[a-z]+ [^>]*class=\"{cls}\"[^>]*>([^<]*)'"
    found = _plain(f"regexp_extract(html, {pat}, 1)")
    return f"CASE WHEN regexp_matches(html, {pat}) THEN {_strip_ws(found) if strip else found} ELSE '{default}' END"


def _texts(pat):
    return f"list_transform(regexp_extract_all(html, {pat}, 1), lambda x: {_plain('x')})"


_A_TEXTS = _texts("'<a(?: [^>]*)?>([^<]*)'")
_AD_TEXTS = _texts("'<[a-z]+ [^>]*class=\"ad\"[^>]*>([^<]*)'")


def _pick(links, seed):
    return (f"CASE WHEN len({links}) > 0 THEN {links}[(({seed} % len({links})) + len({links})) "
            f"% len({links}) + 1] ELSE 'No image found' END")


def _tags():
    joined = f"array_to_string(list_transform({_AD_TEXTS}, lambda t: {_strip_ws('t')}), '')"
    return f"list_filter(string_split({joined}, chr(9)), lambda p: p NOT IN ('', chr(13) || chr(10), '+'))"


def _disc(base, disc_found):
    return f"CASE WHEN {base} = 'Free to Play' THEN 'No Discount' ELSE coalesce(nullif({disc_found}, ''), 'No Discount') END"


ORACLE["page_meta"] = (
    f"SELECT page_id, {_meta('charset', None, 'charset')} AS charset, "
    f"{_meta('property', 'og:description', 'content')} AS description FROM pages")
ORACLE["page_links"] = f"SELECT page_id, array_to_string({_links()}, '|') AS links FROM pages"
ORACLE["page_pick_link"] = f"SELECT page_id, {_pick(_links(), 'page_id')} AS image FROM pages"
ORACLE["page_text_by_class"] = f"SELECT page_id, {_text('ad', 'Not found')} AS base_price FROM pages"
ORACLE["page_price_rule"] = (
    f"SELECT page_id, {_text('ad', 'Not found')} AS base_price, "
    f"{_disc(_text('ad', 'Not found'), _text('discount_final_price', ''))} AS discount_price FROM pages")
ORACLE["page_text_raw"] = (
    f"SELECT page_id, {_text('ad', 'not found', strip=False)} AS review FROM pages")
ORACLE["page_texts"] = f"SELECT page_id, array_to_string({_A_TEXTS}, '|') AS texts FROM pages"
ORACLE["page_tag_list"] = f"SELECT page_id, array_to_string({_tags()}, '|') AS tags FROM pages"
ORACLE["tag_counts"] = (
    f"SELECT tag, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest({_A_TEXTS}) AS tag "
    "FROM pages) GROUP BY tag")

_FIELDS = f"""npages AS (SELECT count(*) AS n FROM pages),
pf AS (SELECT page_id, {_meta('charset', None, 'charset')} AS description,
              {_pick(_links(), 'page_id')} AS image,
              {_text('ad', 'Not found')} AS base_price,
              {_disc(_text('ad', 'Not found'), _text('discount_final_price', ''))} AS discount_price,
              {_text('ad', 'not found', strip=False)} AS review FROM pages)"""
ORACLE["enrich_hits"] = full(
    "SELECT t.query_id, t.rank, t.doc_id, t.score, "
    f"coalesce(pf.description, {_s('No description found')}) AS description, "
    f"coalesce(pf.image, {_s('No image found')}) AS image, "
    f"coalesce(pf.base_price, {_s('Not found')}) AS base_price, "
    f"coalesce(pf.discount_price, {_s('No Discount')}) AS discount_price, "
    f"coalesce(pf.review, {_s('not found')}) AS review "
    "FROM top t CROSS JOIN npages LEFT JOIN pf ON pf.page_id = ((t.doc_id % npages.n) + npages.n) % npages.n",
    extra=_FIELDS)

# --- lookups --------------------------------------------------------------------
_PARTCAT = ("(SELECT p_partkey, 'part/' || CAST(p_partkey AS VARCHAR) AS url, p_name AS name, "
            "p_type AS categories, p_brand AS developer FROM part)")
ORACLE["docs_by_category"] = f"SELECT * FROM {_PARTCAT} WHERE contains(categories, 'AR')"
ORACLE["url_by_name"] = f"SELECT url FROM {_PARTCAT} WHERE name = 'red plate'"
ORACLE["doc_by_name"] = f"SELECT * FROM {_PARTCAT} WHERE name = 'red plate'"
ORACLE["term_lookup"] = index_only(
    "SELECT p.term, s.df, s.cf, p.doc_id, p.tf FROM post p JOIN stats s ON p.term = s.term "
    "WHERE p.term = 'the'")

ORACLE["search_flow"] = full(
    "SELECT s.query_id, s.n_hits, s.status, t.rank, t.doc_id, t.score, "
    + ", ".join(
        f"CASE WHEN t.doc_id IS NULL THEN NULL ELSE coalesce(pf.{c}, {_s(d)}) END AS {c}"
        for c, d in [("description", 'No description found'), ("image", 'No image found'),
                     ("base_price", 'Not found'), ("discount_price", 'No Discount'),
                     ("review", 'not found')])
    + " FROM st s LEFT JOIN top t ON t.query_id = s.query_id CROSS JOIN npages "
    "LEFT JOIN pf ON pf.page_id = ((t.doc_id % npages.n) + npages.n) % npages.n",
    extra=_FIELDS + """,
st AS (SELECT q.qid AS query_id, CAST(count(t.doc_id) AS BIGINT) AS n_hits,
              CASE WHEN count(t.doc_id) > 0 THEN 'found' ELSE 'no_result' END AS status
       FROM """ + _NAMEQ + """ q LEFT JOIN top t ON t.query_id = q.qid GROUP BY q.qid)""",
    query_source=_NAMEQ, id_expr="qid", text_expr="p_name || ' Singleplayer' || ' Online'",
    synonyms=True)

# the reference's main pipeline: cleaned catalogue -> document text -> index -> urls
_CAT_DOCS = _CLEAN_CTES + """,
catdocs AS (SELECT doc_id, url, ' ' || coalesce(name, 'nan') || ' ' || coalesce(categories, 'nan') || ' ' ||
                   coalesce(developer, 'nan') || ' ' || coalesce("desc", 'nan') AS text FROM cleaned)"""
ORACLE["catalog_search"] = (
    "WITH " + ",\n".join([_CAT_DOCS, index_ctes("catdocs", "doc_id", "text"), query_ctes(), score_ctes(10)])
    + "\nSELECT t.query_id, t.rank, t.doc_id, t.score, d.url FROM top t JOIN catdocs d ON t.doc_id = d.doc_id")
