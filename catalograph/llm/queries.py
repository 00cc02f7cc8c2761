"""One registered query for each operator, over whole tables, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm import (bpe, language, mixing, personal, phrases, quality, secrets, setsketch, sharding,
                             tokens_orc, urls, variants, vectors)
from catalograph.llm.support import new_path, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[name] = shipped
        if sql:
            ORACLES[name] = sql
        return shipped

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; only these queries know it, operators take paths."""
    import public_tokenizers

    return public_tokenizers.path(name)


# The host and path rules.
HOST_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
# The method's own pattern rules for every other URL: (pattern, verdict).
PATTERN_RULES = (
    ("/ads/", "block"),
    ("/banner/*.html", "block"),
    ("/login^", "block"),
    ("/print/", "block"),
    ("/search?q=", "block"),
    ("&ref=", "block"),
    ("?utm_source=", "block"),
    ("?page=*&ref=", "block"),
    ("||track.", "block"),
    ("||ads.", "block"),
    ("||m.", "block"),
    ("||blog.", "allow"),
    ("/de/*.html|", "allow"),
)


def url_rules() -> list[urls.UrlRule]:
    return [urls.host_rule(name, verdict) for name, verdict in HOST_RULES] + [
        urls.UrlRule(pattern, verdict, len(pattern)) for pattern, verdict in PATTERN_RULES]


def _sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _url_sql() -> str:
    rules = ", ".join(
        f"({_sql_text(urls.regular_expression(r.pattern))}, {_sql_text(r.pattern)}, {_sql_text(r.verdict)}, "
        f"{r.strength}, {_sql_text(r.name)})" for r in url_rules())
    return f"""
WITH rules(expression, pattern, verdict, strength, rule) AS (VALUES {rules}),
parts AS (SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*(.*)$', 1, 's'), '') AS rest FROM pages),
best AS (SELECT u.url, max(struct_pack(s := r.strength, p := r.pattern, v := r.verdict, n := r.rule)) AS b
    FROM (SELECT DISTINCT url, host || rest AS subject FROM parts) u JOIN rules r
    ON u.subject <> '' AND regexp_matches(u.subject, r.expression) GROUP BY u.url)
SELECT page_id, host, path, b.n AS rule, coalesce(b.v, 'allow') AS verdict, b.p AS pattern
FROM parts LEFT JOIN best USING (url)"""


@query("op1_hilbert_shards")
def hilbert_shards(spark, sf_dir):
    return sharding.hilbert_shards(table(spark, sf_dir, "documents"))


@query("op2_cover_tree_near_duplicates")
def cover_tree(spark, sf_dir):
    return vectors.link_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_language_bitmask_filters")
def languages(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language.held_out(F.col("doc_id"))
    return (language.identify(documents, documents.where(~held_out))
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


@query("op4_forest_secret_scan")
def secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"), secrets.labelled_findings(spark))


@query("op5_soft_membership_mixing")
def soft_mixing(spark, sf_dir):
    return mixing.document_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_url_token_rules", _url_sql())
def url_rules_query(spark, sf_dir):
    return urls.filter_pages(table(spark, sf_dir, "pages"), url_rules())


@query("op7_setsketch_near_duplicates")
def setsketch_query(spark, sf_dir):
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_orc_token_files")
def orc_tokens(spark, sf_dir):
    target = new_path(spark, "tokens.orc")
    tokens_orc.write_tokens(table(spark, sf_dir, "documents"), target, vocabulary("byte_bpe_50k.json"), end_id=0)
    return tokens_orc.token_index(tokens_orc.read_tokens(spark, target))


@query("op9_hashed_ngram_quality")
def quality_query(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_byte_level_bpe")
def bpe_query(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(documents, vocabulary("byte_bpe_multi_50k.tiktoken")))


_PHRASE_SQL = r"""
WITH texts AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM
    (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM lists, (VALUES (1), (2), (3), (4)) s(m) WHERE len(w) >= m)),
counted AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE a >= 30),
inside AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, array_to_string(w[i:i + s - 1], ' ') AS phrase FROM
    (SELECT lang, a, w, s, unnest(range(1, m - s + 2)) AS i FROM frequent, (VALUES (2), (3)) z(s) WHERE m > s))
    GROUP BY lang, phrase),
kept AS (SELECT f.* FROM frequent f LEFT JOIN inside i USING (lang, phrase)
    WHERE m > 1 AND (longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT)),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:], ' ') AS q FROM
    (SELECT *, unnest(range(1, m)) AS k FROM kept)),
scored AS (SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a // (x.a + y.a))::BIGINT AS score
    FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = p JOIN frequent y ON y.lang = c.lang AND y.phrase = q),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
    FROM weakest WHERE nth = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""


@query("op11_phrase_collocations", _PHRASE_SQL)
def collocations(spark, sf_dir):
    return phrases.mine(table(spark, sf_dir, "documents").select("text", "lang"))


@query("op12_personal_data_field")
def personal_data(spark, sf_dir):
    model = personal.fit(personal.labelled_lines(spark))
    return personal.digests(personal.find(table(spark, sf_dir, "documents").select("doc_id", "text"), model))


_VARIANT_SQL = """
WITH RECURSIVE steps AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
found AS (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' AS id, run, count(*) AS n FROM found WHERE length(run) >= 7 GROUP BY ALL),
summed AS (SELECT run, n, 4294967295 - list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])) AS h FROM runs, steps),
words AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
    ELSE run END AS word, n FROM summed),
counted AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest FROM
    (SELECT *, unnest(range(length(word))) AS i FROM counted)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN counted b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN counted b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS top, max(other_n) AS top_n FROM near GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 10 * n THEN top END AS form,
    CASE WHEN top_n >= 10 * n THEN top_n END AS form_n FROM counted LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM formed UNION ALL
    SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word
WHERE NOT EXISTS (SELECT 1 FROM formed g WHERE g.word = c.root AND g.form IS NOT NULL)"""


@query("op13_gram_spelling_variants", _VARIANT_SQL)
def spelling_variants(spark, sf_dir):
    return variants.group_spellings(table(spark, sf_dir, "documents").select("doc_id", "text"))
