"""State sequences and word-pair models."""

from pyspark.sql import functions as F

from ..operators import sequences as Q
from ..operators.ordered import micros
from ..registry import query

R = F.round
TOK = r"list_concat(['<s>'], regexp_split_to_array(lower(trim(text, ' ')), '\s+'), ['</s>'])"
MODEL = rf"""tok AS (SELECT doc_id, {TOK} AS t FROM documents), u AS (SELECT unnest(t) AS token FROM tok), uni AS (SELECT token, count(*) AS n FROM u GROUP BY 1),
  pr AS (SELECT unnest(list_zip(t[:-2], t[2:])) AS p FROM tok), bi AS (SELECT p[1] AS prev, p[2] AS cur, count(*) AS n FROM pr GROUP BY 1, 2),
  vs AS (SELECT count(*) FILTER (token <> '<s>') AS v FROM uni)"""


@query(
    "seq1",
    """WITH s AS (SELECT event_type AS state, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next FROM events), c AS (SELECT state, next, count(*) AS n FROM s WHERE next IS NOT NULL GROUP BY 1, 2)
       SELECT state, next, n, round(n / sum(n) OVER (PARTITION BY state), 10) AS p FROM c""",
)
def transition_table(t):
    df = t.events.select("event_id", "user_id", micros("ts").alias("at"), "event_type")
    return Q.transitions(df, ["user_id"], "at", "event_type", "event_id").withColumn("p", R("p", 10))


@query("seq1_frequency", "SELECT event_type AS state, round(count(*) / (SELECT count(*) FROM events), 10) AS share FROM events GROUP BY 1")
def state_shares(t):
    counts = t.events.groupBy(F.col("event_type").alias("state")).agg(F.count("*").alias("n"))
    return counts.select("state", R(F.col("n") / counts.agg(F.sum("n")).scalar(), 10).alias("share"))


@query(
    "seq2",
    """WITH RECURSIVE s AS (SELECT event_type AS state, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next FROM events),
       c AS (SELECT state, next, count(*) AS n FROM s WHERE next IS NOT NULL GROUP BY 1, 2), p AS (SELECT state, next, n / sum(n) OVER (PARTITION BY state) AS p FROM c),
       v AS (SELECT state FROM p UNION SELECT next FROM p), k AS (SELECT count(*) AS k FROM v),
       r AS (SELECT 0 AS i, state, 1.0::DOUBLE / k AS pi FROM v, k
             UNION ALL SELECT i + 1, q.next, sum(q.p * pi) FROM r JOIN (SELECT state, next, p / 2 AS p FROM p UNION ALL SELECT state, state, 0.5 FROM v) q ON q.state = r.state WHERE i < 200 GROUP BY i, q.next)
       SELECT state, round(sum(pi), 8) AS pi FROM r WHERE i = 200 GROUP BY 1""",
)
def stationary_distribution(t):
    df = t.events.select("event_id", "user_id", micros("ts").alias("at"), "event_type")
    return Q.stationary(Q.transitions(df, ["user_id"], "at", "event_type", "event_id")).select("state", R("pi", 8).alias("pi"))


@query("seq3", f"WITH {MODEL} SELECT prev, cur, n FROM bi")
def pair_counts(t):
    return Q.bigrams(t.documents, "text")


@query("seq3_unigram", f"WITH {MODEL} SELECT token, n FROM uni")
def token_counts(t):
    return Q.unigrams(t.documents, "text")


@query("seq4", f"WITH {MODEL} SELECT prev, cur, round((bi.n + 0.5) / (uni.n + 0.5 * v), 12) AS p FROM bi JOIN uni ON prev = token, vs")
def smoothed_probability(t):
    uni, bi = Q.unigrams(t.documents, "text"), Q.bigrams(t.documents, "text")
    both = bi.join(uni.select(F.col("token").alias("prev"), F.col("n").alias("c")), "prev")
    return both.withColumn("v", Q.vocabulary_size(uni)).select(
        "prev", "cur", R(Q.smoothed(F.col("n"), F.col("c"), 0.5, F.col("v")), 12).alias("p")
    )


@query(
    "seq5",
    rf"""WITH {MODEL}, bt AS (SELECT item_id, {TOK} AS t FROM benchmark), bp AS (SELECT item_id, unnest(list_zip(t[:-2], t[2:])) AS p FROM bt),
        s AS (SELECT item_id, ln((coalesce(bi.n, 0) + 0.5) / (coalesce(uni.n, 0) + 0.5 * v)) AS lp FROM bp LEFT JOIN bi ON p[1] = prev AND p[2] = cur LEFT JOIN uni ON p[1] = token, vs)
        SELECT item_id, round(sum(lp), 8) AS log_probability, count(*) AS n_pairs, round(exp(-sum(lp) / count(*)), 6) AS perplexity FROM s GROUP BY 1""",
)
def text_perplexity(t):
    p = Q.perplexity(t.documents, "text", t.benchmark, "item_id", "text")
    return p.select("item_id", R("log_probability", 8).alias("log_probability"), "n_pairs", R("perplexity", 6).alias("perplexity"))


def tagged(t):
    """Conversations as tagged sequences: the role is the tag of every word of a turn."""
    return Q.word_rows(t.conversations.withColumnRenamed("role", "tag"), "text", "conv_id", "turn", "tag")


@query(
    "seq6",
    r"""WITH x AS (SELECT conv_id, turn, role AS tag, regexp_split_to_array(lower(trim(text, ' ')), '\s+') AS w FROM conversations), y AS (SELECT conv_id, turn, tag, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM x),
       r AS (SELECT *, lag(tag) OVER (PARTITION BY conv_id ORDER BY turn, place) AS prev FROM y),
       tags AS (SELECT DISTINCT tag FROM r), k AS (SELECT count(*) AS k FROM tags), tc AS (SELECT tag, count(*) AS n FROM r GROUP BY 1),
       st AS (SELECT tag, count(*) AS n FROM r WHERE prev IS NULL GROUP BY 1), ns AS (SELECT sum(n) AS s FROM st),
       tr AS (SELECT prev, tag, count(*) AS n FROM r WHERE prev IS NOT NULL GROUP BY 1, 2), og AS (SELECT prev, sum(n) AS o FROM tr GROUP BY 1),
       em AS (SELECT tag, word, count(*) AS n FROM r GROUP BY 1, 2), w AS (SELECT count(DISTINCT word) AS w FROM r)
       SELECT 'start' AS kind, CAST(NULL AS VARCHAR) AS given, tags.tag AS outcome, round((coalesce(st.n, 0) + 0.1) / (s + 0.1 * k), 10) AS p FROM tags LEFT JOIN st USING (tag), ns, k
       UNION ALL SELECT 'transition', a.tag, b.tag, round((coalesce(tr.n, 0) + 0.1) / (coalesce(o, 0) + 0.1 * k), 10) FROM tags a JOIN tags b ON true LEFT JOIN tr ON tr.prev = a.tag AND tr.tag = b.tag LEFT JOIN og ON og.prev = a.tag, k
       UNION ALL SELECT 'emission', em.tag, word, round((em.n + 0.1) / (tc.n + 0.1 * (w + 1)), 10) FROM em JOIN tc ON em.tag = tc.tag, w
       UNION ALL SELECT 'emission', tag, NULL, round(0.1 / (n + 0.1 * (w + 1)), 10) FROM tc, w""",
)
def hidden_markov_tables(t):
    start, transition, emission, _ = Q.hmm_tables(tagged(t), "conv_id", "turn", "word", "tag", tie=["at"])
    kind = lambda k: F.lit(k).alias("kind")
    p = R("p", 10).alias("p")
    return (
        start.select(kind("start"), F.lit(None).cast("string").alias("given"), F.col("tag").alias("outcome"), p)
        .union(transition.select(kind("transition"), "prev", "tag", p))
        .union(emission.select(kind("emission"), "tag", "word", p))
    )


@query("seq7")
def most_probable_tags(t):
    rows = tagged(t)
    return Q.decode(rows, "conv_id", "turn", "word", Q.hmm_tables(rows, "conv_id", "turn", "word", "tag", tie=["at"]), tie=["at"])
