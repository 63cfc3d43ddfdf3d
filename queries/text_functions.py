"""Text functions over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmurio.functions import text as X
from murmurio.functions.wordlists import ASCII_SPELLING, GENERIC_NOISE

from .base import NS, NW, S, W, query, slugify_sql, strip_sql, term_of, tokens_sql, TERM_SQL

STOPWORDS = sorted({*GENERIC_NOISE, "the", "and", "for", "that", "of", "in", "is", "on", "un",
                    "la", "le", "les", "der", "die", "und", "que", "el", "dans", "ção", "é"})
IN_STOPWORDS = "(" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"


def q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def unidecode_sql(x: str) -> str:
    out = f"lower({x})"
    for source, target in ASCII_SPELLING.items():
        out = f"replace({out}, {q(source)}, {q(target)})"
    return rf"regexp_replace(strip_accents({out}), '[^\x00-\x7F\p{{L}}\p{{N}}]', '', 'g')"


def tweet_sql(x):
    return strip_sql(f"regexp_replace({x}, '[@#]{NS}+ *', '', 'g')")


def urls_sql(x):
    return strip_sql(f"regexp_replace({x}, 'http{NS}+ *', '', 'g')")


PUNCTUATION = r"""\\\)|[()!"#$%&'*+,\-./:;<=>?@\[\]^_`{}~|\r\n]"""


def punctuation_sql(x):
    blanked = f"regexp_replace({x}, {q(PUNCTUATION)}, ' ', 'g')"
    return strip_sql(f"regexp_replace({blanked}, ' {{2,}}', ' ', 'g')")


def short_sql(x, n=3):
    pieces = f"regexp_extract_all({x}, '{W}+ ?|{NW}')"
    return strip_sql(f"array_to_string(list_transform({pieces}, lambda p: CASE WHEN "
                     f"regexp_matches(p, '^{W}{{1,{n}}} ?$') THEN '' ELSE p END), '')")


def stopwords_sql(x):
    pieces = f"regexp_extract_all({x}, '{W}+ *|{NW}+')"
    return strip_sql(f"array_to_string(list_filter({pieces}, lambda p: rtrim(p, ' ') NOT IN "
                     f"{IN_STOPWORDS}), '')")


def collapse_sql(x):
    """Drop a character that equals the two before it: every character is paired with those."""
    chars = f"string_split({x}, '')"
    zipped = f"list_zip({chars}, list_concat([''], {chars}), list_concat(['', ''], {chars}))"
    return (f"array_to_string(list_transform(list_filter({zipped}, lambda c: c[1] IS NOT NULL AND "
            f"NOT (c[1] <> chr(10) AND c[1] = c[2] AND c[1] = c[3])), lambda c: c[1]), '')")


def vowels_sql(x):
    for v in "aeiou":
        x = f"regexp_replace({x}, '{v}{{2,}}', '{v}', 'g')"
    return x


# name -> (Column function, SQL of the same over column t)
FUNCTIONS = {
    "strip": (X.strip, strip_sql("t")),
    "lowercase_unidecode": (X.lowercase_unidecode, unidecode_sql("t")),
    "remove_accents": (X.remove_accents, "strip_accents(t)"),
    "remove_urls": (X.remove_urls, urls_sql("t")),
    "strip_links": (X.strip_links, f"regexp_replace(t, 'http{NS}+|www{NS}+', ' ', 'g')"),
    "remove_tweet_marking": (X.remove_tweet_marking, tweet_sql("t")),
    "remove_punctuation": (X.remove_punctuation, punctuation_sql("t")),
    "collapse_vowels": (X.collapse_vowels, vowels_sql("t")),
    "remove_stopwords": (lambda c: X.remove_stopwords(c, STOPWORDS), stopwords_sql("t")),
    "remove_short_words": (lambda c: X.remove_short_words(c, 3), short_sql("t")),
    "remove_numbers": (X.remove_numbers, "regexp_replace(t, '[0-9] *', '', 'g')"),
    "remove_gerund": (X.remove_gerund, rf"regexp_replace(t, 'ndo({NW}|$)', '\1', 'g')"),
    "remove_infinitive": (X.remove_infinitive, rf"regexp_replace(t, 'r({NW}|$)', '\1', 'g')"),
    "squeeze_spaces": (X.squeeze_spaces, strip_sql(f"regexp_replace(t, '{S}+', ' ', 'g')")),
    "classifier_text": (X.classifier_text, strip_sql(
        f"regexp_replace(regexp_replace(t, 'http{NS}+|www{NS}+', ' ', 'g'), '{S}+', ' ', 'g')")),
    "drop_non_ascii_tokens": (X.drop_non_ascii_tokens, (
        f"array_to_string(list_filter({tokens_sql('lower(t)')}, lambda x: "
        r"regexp_full_match(x, '[\x00-\x7F]+')), ' ')")),
    "slugify": (X.slugify, slugify_sql("t")),
    "slug": (X.slug, (
        "coalesce(nullif(regexp_replace(regexp_replace(lower(" + strip_sql("t") + "), "
        f"'[^a-z0-9áàâãéêíóôõúüç_\\-{S[1:-1]}]', '', 'g'), '{S}+', '_', 'g'), ''), 'sem_nome')")),
    "alnum_slug": (X.alnum_slug, r"regexp_replace(lower(t), '[^\p{L}\p{N}]', '_', 'g')"),
    "signature_text": (X.signature_text, "substr(" + strip_sql(
        f"regexp_replace(regexp_replace(lower(t), '[^a-z0-9À-ÿ{S[1:-1]}]', '', 'g'), "
        f"'{S}+', ' ', 'g')") + ", 1, 60)"),
    "vectorizer_normalize": (lambda c: X.vectorizer_normalize(c, vowels=True),
                             vowels_sql("strip_accents(lower(t))")),
}


def _register(name, fn, expr):
    @query(f"text.{name}", f"SELECT doc_id, {expr} AS texto FROM decorated")
    def run(t):
        return t.decorated().select("doc_id", fn(F.col("t")).alias("texto"))


for _name, (_fn, _expr) in FUNCTIONS.items():
    _register(_name, _fn, _expr)


@query("text.remove_repeated_words", f"""
    WITH lists AS (SELECT doc_id, regexp_extract_all(t, '{W}+|{NW}+') AS l FROM decorated),
    p AS (SELECT doc_id, unnest(l) AS piece, unnest(range(1, len(l) + 1)) AS i FROM lists),
    n AS (SELECT *, regexp_matches(piece, '^{W}') AS is_word, coalesce(lead(piece, 2) OVER w = piece
              AND regexp_full_match(lead(piece, 1) OVER w, '{S}+'), FALSE) AS same_next
          FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM n WHERE is_word),
    g AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id, same_next ORDER BY k) AS run FROM k),
    s AS (SELECT doc_id, i, same_next AND row_number() OVER (PARTITION BY doc_id, same_next, run
              ORDER BY k) % 2 = 1 AS pair_start FROM g)
    SELECT p.doc_id, string_agg(piece, '' ORDER BY p.i) AS texto FROM p
    LEFT JOIN s a ON a.doc_id = p.doc_id AND a.i = p.i - 1
    LEFT JOIN s b ON b.doc_id = p.doc_id AND b.i = p.i - 2
    WHERE NOT coalesce(a.pair_start, FALSE) AND NOT coalesce(b.pair_start, FALSE)
    GROUP BY p.doc_id""")
def remove_repeated_words(t):
    """Runs of equal words are taken in pairs, from the left."""
    return t.decorated().select("doc_id", X.remove_repeated_words("t").alias("texto"))


@query("text.collapse_chars", f"""
    SELECT doc_id, {collapse_sql("t")} AS texto
    FROM (SELECT doc_id, regexp_replace(text, '([aeo])', '\\1\\1\\1', 'g') AS t FROM documents)""")
def collapse_chars(t):
    tripled = F.regexp_replace("text", "([aeo])", "$1$1$1")
    return t.texts().select("doc_id", X.collapse_chars(tripled).alias("texto"))


@query("text.remove_numbers_filter", """
    SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]') THEN '' ELSE text END AS texto
    FROM documents""")
def remove_numbers_filter(t):
    return t.texts().select("doc_id", X.remove_numbers("text", "filter").alias("texto"))


@query("text.remove_html_tags", f"""
    SELECT page_id, {strip_sql("regexp_replace(html, '<.*?> *', '', 'g')")} AS texto FROM pages""")
def remove_html_tags(t):
    return t.pages.select("page_id", X.remove_html_tags("html").alias("texto"))


@query("text.join_text", f"""
    SELECT doc_id, coalesce(nullif(array_to_string(list_filter([
        {strip_sql('title')}, {strip_sql('selftext')}, {strip_sql('body')}],
        lambda x: x IS NOT NULL AND x <> ''), ' '), ''), '<null>') AS texto FROM raw_reddit""")
def join_text(t):
    joined = X.join_text("title", "selftext", "body")
    return t.raw_reddit().select("doc_id", F.coalesce(joined, F.lit("<null>")).alias("texto"))


@query("text.join_list_text", """
    SELECT id, array_to_string(list_filter([url, ' ', html, NULL], lambda x: x IS NOT NULL AND
        x <> ''), ' ') AS texto FROM ads""")
def join_list_text(t):
    return t.ads().select("id", X.join_list_text("ad_creative_bodies").alias("texto"))


@query("text.concat_columns", """
    SELECT doc_id, coalesce(title, '') || ' ' || coalesce(selftext, '') || ' '
        || coalesce(body, '') AS texto FROM raw_reddit""")
def concat_columns(t):
    return t.raw_reddit().select("doc_id", X.concat_columns("title", "selftext", "body").alias(
        "texto"))


@query("text.clear_removed_marker", f"""
    SELECT doc_id, CASE WHEN lower({strip_sql("coalesce(body, '')")}) IN ('[removed]', '[deleted]')
        THEN '' ELSE {strip_sql("coalesce(body, '')")} END AS texto FROM raw_reddit""")
def clear_removed_marker(t):
    return t.raw_reddit().select("doc_id", X.clear_removed_marker("body").alias("texto"))


@query("text.drop_tokens", f"""
    SELECT doc_id, array_to_string(list_filter({tokens_sql("'Removed ' || text || ' deleted'")},
        lambda x: lower(x) NOT IN ('removed', 'deleted')), ' ') AS texto FROM documents""")
def drop_tokens(t):
    marked = F.concat(F.lit("Removed "), "text", F.lit(" deleted"))
    return t.texts().select("doc_id", X.drop_tokens(marked).alias("texto"))


@query("text.extract_hashtags", f"""
    SELECT doc_id, array_to_string(regexp_extract_all(lower(t), '#{W}+'), ' ') AS hashtags
    FROM decorated""")
def extract_hashtags(t):
    return t.decorated().select(
        "doc_id", F.array_join(X.extract_hashtags("t"), " ").alias("hashtags"))


@query("text.extract_words", """
    SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[a-zA-ZÀ-ÿ]+'),
        lambda x: length(x) >= 3), ' ') AS palavras FROM documents""")
def extract_words(t):
    return t.texts().select(
        "doc_id", F.array_join(X.extract_words("text", 3), " ").alias("palavras"))


@query("text.normalize_target", f"""
    SELECT doc_id, coalesce(nullif(regexp_replace(
        {strip_sql("' r/' || source || ' '")}, '^r/', ''), ''), '<null>') AS canal,
        coalesce(nullif(regexp_replace({strip_sql("substr('  r/', 1, CAST(n_chars % 5 AS INT))")},
        '^r/', ''), ''), '<null>') AS vazio FROM documents""")
def normalize_target(t):
    written = F.concat(F.lit(" r/"), "source", F.lit(" "))
    empty = F.substring(F.lit("  r/"), F.lit(1), (F.col("n_chars") % 5).cast("int"))
    null = F.lit("<null>")
    return t.texts().select("doc_id", F.coalesce(X.normalize_target(written), null).alias("canal"),
                              F.coalesce(X.normalize_target(empty), null).alias("vazio"))


@query("text.same_name", f"""
    SELECT doc_id, strip_accents(lower({strip_sql("'  ' || text || ' '")}))
        = strip_accents(lower({strip_sql("strip_accents(lower(text))")})) AS igual,
        strip_accents(lower({strip_sql("text")})) = strip_accents(lower({strip_sql("source")}))
        AS igual_fonte FROM documents""")
def same_name(t):
    padded = F.concat(F.lit("  "), "text", F.lit(" "))
    return t.texts().select(
        "doc_id", X.same_name(padded, X.remove_accents(F.lower("text"))).alias("igual"),
        X.same_name("text", "source").alias("igual_fonte"))


@query("terms.expand", f"""
    SELECT doc_id, CASE WHEN contains(v, ' ') THEN '"' || v || '"' ELSE v END AS termo, original
    FROM (SELECT doc_id, {TERM_SQL} AS original,
                 unnest(list_distinct([{TERM_SQL}, strip_accents({TERM_SQL})])) AS v
          FROM documents)""")
def expand_terms(t):
    return t.texts().select("doc_id", term_of("lang").alias("original")).select(
        "doc_id", "original", F.explode(X.term_variants("original")).alias("termo"))


@query("text.strip_nul", """
    SELECT doc_id, replace(text, ' ', '') AS texto, replace(text, ' ', '') AS json
    FROM documents""")
def strip_nul(t):
    import murmurio.functions.json as J

    broken = F.replace("text", F.lit(" "), F.lit("\x00"))
    packed = J.metadata_json(v=broken)
    return t.texts().select("doc_id", X.strip_nul(broken).alias("texto"),
                              F.from_json(packed, "v string")["v"].alias("json"))


@query("text.capitalize", """
    SELECT doc_id, upper(substr(lang || source, 1, 1)) || lower(substr(lang || source, 2)) AS nome,
        'Form_' || lpad(CAST(n_chars % 1000 AS VARCHAR), 4, '0') AS item FROM documents""")
def capitalize(t):
    return t.texts().select(
        "doc_id", X.capitalize(F.concat("lang", "source")).alias("nome"),
        X.numbered(F.lit("Form"), F.col("n_chars") % 1000, 4).alias("item"))


@query("text.urls", """
    SELECT doc_id, 'https://www.youtube.com/watch?v=' || doc_id AS video,
        coalesce('https://reddit.com' || permalink, '<null>') AS post FROM raw_reddit""")
def urls(t):
    return t.raw_reddit().select(
        "doc_id", X.watch_url(F.col("doc_id").cast("string")).alias("video"),
        F.coalesce(X.permalink_url("permalink"), F.lit("<null>")).alias("post"))


@query("text.join_tags", """
    SELECT doc_id, array_to_string([lang, source], ',') AS tags,
        CASE WHEN lang = 'en' THEN 'SIM' ELSE 'NÃO' END AS ingles FROM documents""")
def join_tags(t):
    return t.texts().select("doc_id", X.join_tags(F.array("lang", "source")).alias("tags"),
                              X.yes_no(F.col("lang") == "en").alias("ingles"))


@query("text.network_of", """
    SELECT event_id, CASE WHEN event_type = 'view' THEN 'youtube' WHEN event_type = 'click'
        THEN 'reddit' ELSE event_type || '_raw' END AS rede FROM events""")
def network_of(t):
    names = (F.when(F.col("event_type") == "view", "YouTube_comments")
             .when(F.col("event_type") == "click", "reddit")
             .otherwise(F.concat("event_type", F.lit("_raw"))))
    return t.events.select("event_id", X.network_of(names).alias("rede"))


@query("text.strip_name_tokens", f"""
    SELECT doc_id, array_to_string(list_filter({tokens_sql("lower(text)")}, lambda x:
        NOT list_contains(regexp_extract_all(lower(lang || ' ' || {TERM_SQL} || ' the un'),
        '[a-zA-ZÀ-ÿ]{{2,}}'), x)), ' ') AS texto FROM documents""")
def strip_name_tokens(t):
    own = F.concat_ws(" ", "lang", term_of("lang"), F.lit("the un"))
    return t.texts().select("doc_id", X.strip_name_tokens(F.lower("text"), own).alias("texto"))


@query("text.first_filled", """
    SELECT id, coalesce(nullif(page_name, ''), nullif(_entidade_busca, ''), nullif(page_id, ''), '')
        AS nome, coalesce(nullif(page_id, ''), _entidade_busca) AS pagina FROM ads""")
def first_filled(t):
    return t.ads().select("id", X.first_filled("page_name", "_entidade_busca", "page_id").alias(
        "nome"), F.coalesce(X.blank_to_null("page_id"), "_entidade_busca").alias("pagina"))


STEPS = [
    ("lowered", strip_sql(f"regexp_replace(lower(t), '{S}+', ' ', 'g')")),
    ("stopped", stopwords_sql("x")),
    ("folded", unidecode_sql("x")),
    ("stopped_again", stopwords_sql("x")),
    ("unmarked", tweet_sql("x")),
    ("collapsed", collapse_sql("x")),
    ("unlinked", urls_sql("x")),
    ("unpunctuated", punctuation_sql("x")),
    ("unnumbered", "regexp_replace(x, '[0-9] *', '', 'g')"),
    ("shortened", short_sql("x")),
]
_chain, _source = [], "decorated"
for _step, _expr in STEPS:
    _chain.append(f"{_step} AS (SELECT doc_id, {_expr} AS x FROM {_source})")
    _source = _step


@query("text.preprocess",
       "WITH " + ", ".join(_chain) + " SELECT doc_id, x AS texto FROM shortened")
def preprocess(t):
    return t.decorated().select("doc_id", X.preprocess("t", STOPWORDS).alias("texto"))
