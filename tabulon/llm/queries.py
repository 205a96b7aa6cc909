"""The registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import chat, embeddings, lines, minhash, mixing, passages, phrases, pieces, pii, quality, repair, spotsigs, tokencounts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: SQL for the operators that have a form in it; tests/llm compares the others with brute-force versions.
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality_classifier")
def _op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op2_line_dedup")
def _op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = lines.dedup_lines(docs, repeats=1, min_left=0, short=True)
    return rows.select("doc_id", "n_lines", "n_removed", "kept", "classes", "text")


@query("op3_fingerprints")
def _op3(spark, sf_dir):
    return spotsigs.fingerprint_documents(table(spark, sf_dir, "documents"))


@query("op4_substring_dedup")
def _op4(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query("op5_mixing")
def _op5(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


@query(
    "op6_minhash_near_dedup",
    r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
       s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM w),
       n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s), x AS (SELECT doc_id, unnest(s) AS g FROM s),
       p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
       e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
       way AS (SELECT a AS x, b AS y FROM e UNION ALL SELECT b, a FROM e),
       r AS (SELECT doc_id AS id, doc_id AS c FROM n UNION SELECT way.y, r.c FROM r JOIN way ON way.x = r.id)
       SELECT n.doc_id, n.n AS n_shingles, min(c) AS component_id, n.doc_id = min(c) AS kept FROM n JOIN r ON r.id = n.doc_id GROUP BY 1, 2""",
)
def _op6(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_pii")
def _op7(spark, sf_dir):
    # the key is an example; it is a parameter of the operator and belongs in the caller's secret store
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pii.pseudonymise(docs, key="example key")
    return rows.select("doc_id", F.size("found").cast("long").alias("n_found"), F.transform("found", lambda f: f["kind"]).alias("kinds"), "text")


#: How often the control strings stand in a text; each gets two characters more, an escape character one.
_MARKS = " + ".join(f"(length(text) - length(replace(text, '{mark}', ''))) // {len(mark)}" for mark in chat.CONTROL)


@query(
    "op8_chat_formatting",
    f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        m AS (SELECT *, 2 * ({_MARKS}) + length(text) - length(replace(text, '{chat.ESCAPE}', '')) AS more FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum({sum(map(len, chat.MARKS))} + length(role) + length(text) + more) AS BIGINT) AS formatted_chars FROM m GROUP BY 1""",
)
def _op8(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_turns(rows))


@query("op9_embedding_near_dedup")
def _op9(spark, sf_dir):
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op10_sentencepiece")
def _op10(spark, sf_dir):
    return pieces.round_trip(table(spark, sf_dir, "documents"), pieces.load_pieces())


@query(
    "op11_phrases",
    r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
       w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
       s AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4), (5)) t(m)),
       f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS n FROM s GROUP BY ALL),
       t AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY 1), c AS (SELECT * FROM f WHERE m > 1 AND n >= 100),
       u AS (SELECT lang, phrase, n AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM c),
       x AS (SELECT u.lang, u.phrase, a, k, h.n AS l, r.n AS r, t.n, CAST((1000::HUGEINT * a * t.n) // (h.n::HUGEINT * r.n) AS BIGINT) AS score FROM u JOIN t ON t.lang = u.lang
         JOIN f h ON h.lang = u.lang AND h.phrase = array_to_string(w[1:k], ' ') JOIN f r ON r.lang = u.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
       y AS (SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = x.lang AND c.n >= x.a AND c.phrase <> x.phrase AND contains(' ' || c.phrase || ' ', ' ' || x.phrase || ' '))
         QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
       SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM y QUALIFY rank <= 2000""",
)
def _op11(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query(
    "op12_conversation_repair",
    r"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)),
         lambda c, b: list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(c, b)), 4294967295), 4294967295) % 20 AS d FROM conversations),
       h AS (SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k),
       n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), copy) AS i FROM h),
       g AS (SELECT *, regexp_replace(text, '[\x20\x09-\x0D]+\z', '') AS shown, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS two, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM n),
       f AS (SELECT *, CASE WHEN shown = '' THEN 'b' WHEN again THEN 'd' WHEN shown[-1:] NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM g),
       ins(q, after, cost, audit, more) AS (VALUES ('', '', 0, '', []), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []), ('', 'u', 3, 'I', ['user:']), ('s', 'u', 3, 'I', ['user:']), ('a', 'u', 3, 'I', ['user:']), ('u', 'a', 3, 'I', ['assistant:']),
         ('', 'a', 6, 'II', ['user:', 'assistant:']), ('s', 'a', 6, 'II', ['user:', 'assistant:'])),
       keep(q, initial) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')), turned(q, after, role) AS (VALUES ('', 'u', 'user:'), ('s', 'u', 'user:'), ('u', 'a', 'assistant:'), ('a', 'u', 'user:')),
       e AS (SELECT conv_id, i, q, q AS after, 4 AS cost, 'D' AS audit, CAST([] AS VARCHAR[]) AS more FROM f, (VALUES (''), ('s'), ('u'), ('a')) t(q)
         UNION ALL SELECT conv_id, i, q, initial, CASE fault WHEN 't' THEN 3 ELSE 0 END, 'K', [role || ':' || text] FROM f JOIN keep ON initial = role[1:1] WHERE fault IN ('', 't')
         UNION ALL SELECT conv_id, i, q, after, CASE fault WHEN 't' THEN 6 ELSE 3 END, 'R', [turned.role || text] FROM f, turned WHERE fault IN ('', 't')),
       o AS (SELECT DISTINCT conv_id FROM conversations),
       dp(conv_id, i, q, best) AS (SELECT conv_id, CAST(0 AS BIGINT), after, {'cost': cost, 'audit': audit, 'text': CAST(more AS VARCHAR[])} FROM o, ins WHERE q = ''
         UNION ALL SELECT dp.conv_id, e.i, ins.after, min({'cost': best.cost + e.cost + ins.cost, 'audit': best.audit || e.audit || ins.audit, 'text': best.text || e.more || CAST(ins.more AS VARCHAR[])})
           FROM dp JOIN e ON e.conv_id IS NOT DISTINCT FROM dp.conv_id AND e.i = dp.i + 1 AND e.q = dp.q JOIN ins ON ins.q = e.after GROUP BY 1, 2, 3),
       z AS (SELECT conv_id, i, min(best) AS best FROM dp WHERE q IN ('', 'a') GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
       s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1)
       SELECT z.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
         sha256(array_to_string(best.text, chr(10))) AS repaired_sha256 FROM z LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM z.conv_id""",
)
def _op12(spark, sf_dir):
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


@query("op13_token_counts")
def _op13(spark, sf_dir):
    return tokencounts.count_tokens(table(spark, sf_dir, "documents"), tokencounts.load_vocabulary())


@query("pipeline")
def _pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
