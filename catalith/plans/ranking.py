"""Queries over vector ranking, exact filters and evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalith.functions.text import fingerprint
from catalith.layout import dictionary_join, rank_within
from catalith.operators import evaluation as ev
from catalith.operators import pruned_knn as pk
from catalith.operators import retrieval as rt
from catalith.plans.registry import Tables, query


def _corpus(t: Tables):
    return t.spread("embeddings").select(F.col("vec_id").alias("id"), F.lit("m1").alias("model"), F.col("embedding").alias("vec"))


def _centroids(t: Tables):
    """Mean vector of each label: the concept side of the ranking."""
    parts = t.spread("embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    mean = parts.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    vec = F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"])
    return mean.groupBy("label").agg(vec.alias("vec")).select(F.col("label").alias("query_id"), F.lit("m1").alias("model"), "vec")


_CENTROID = """part_v AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS v FROM (SELECT label, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) GROUP BY 1, 2),
  cen AS (SELECT label AS q, list(v ORDER BY i) AS c FROM part_v GROUP BY 1),
  sc AS (SELECT q, vec_id, label, list_cosine_similarity(c, CAST(embedding AS DOUBLE[])) AS s FROM cen, embeddings)"""


@query("q39_knn", f"""WITH {_CENTROID}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY round(s, 12) DESC, vec_id) AS INTEGER) AS rank FROM sc)
  SELECT q AS query_id, vec_id AS id, round(s, 6) AS score, rank FROM r WHERE rank <= 10""")
def knn(t: Tables):
    return rt.knn(_centroids(t), _corpus(t), 10).withColumn("score", F.round("score", 6))


def _concept_scores(t: Tables, least: float):
    """Datasets and the concept vectors they reach the threshold with."""
    return rt.concept_scores(_corpus(t).withColumnRenamed("id", "dataset_id"),
                             _centroids(t).withColumnRenamed("query_id", "concept_id"), least)


def _own_scores(t: Tables):
    """Cosine of every dataset with the vector of its own label."""
    cen = _centroids(t).select(F.col("query_id").alias("label"), F.col("vec").alias("centre"))
    rows = dictionary_join(t.spread("embeddings"), cen, ["label"])
    return rows.select(F.col("vec_id").alias("dataset_id"), F.col("label").alias("concept_id"), rt.cosine("centre", "embedding").alias("score"))


@query("q40_concept_candidates", f"""WITH {_CENTROID}, ok AS (SELECT * FROM sc WHERE s >= 0.05 AND NOT EXISTS (SELECT 1 FROM sc o WHERE o.vec_id = sc.vec_id
      AND o.s >= 0.05 AND o.q // 2 = sc.q // 2 AND o.q <> sc.q AND (o.s, o.q) > (sc.s, sc.q))),
  r AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, q) AS INTEGER) AS rank, max(s) OVER (PARTITION BY vec_id) - s AS m FROM ok)
  SELECT vec_id AS dataset_id, q AS concept_id, round(s, 6) AS score, rank, round(m, 6) AS margin FROM r WHERE rank <= 3""")
def concept_candidates(t: Tables):
    # Odd concepts stand one level under the even concept before them.
    tree = t.embeddings.select(F.col("label").alias("concept_id")).distinct().filter(F.col("concept_id") % 2 == 1).select(
        "concept_id", (F.col("concept_id") - 1).alias("ancestor"))
    c = rt.concept_candidates(_concept_scores(t, 0.05), 0.05, 3, tree)
    return c.select("dataset_id", "concept_id", F.round("score", 6).alias("score"), "rank", F.round("margin", 6).alias("margin"))


@query("q171_cosine", f"""WITH {_CENTROID} SELECT q AS concept_id, count(*) AS n, round(sum(s), 5) AS total, round(min(s), 6) AS lo, round(max(s), 6) AS hi FROM sc WHERE q = label GROUP BY 1""")
def cosine(t: Tables):
    return _own_scores(t).groupBy("concept_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("score"), 5).alias("total"),
                                                        F.round(F.min("score"), 6).alias("lo"), F.round(F.max("score"), 6).alias("hi"))


@query("q41_exact_filter", """SELECT doc_id, CASE WHEN lang = 'de' THEN 'unknown' ELSE 'match' END AS filter_lang,
    CASE WHEN n_chars < 500 THEN 'unknown' ELSE 'match' END AS filter_period, CASE WHEN lang = 'de' OR n_chars < 500 THEN 'unknown' ELSE 'match' END AS filter_state
  FROM documents WHERE lang IN ('en', 'de') AND NOT (n_chars BETWEEN 500 AND 999)""")
def exact_filter(t: Tables):
    n = F.col("n_chars")
    start = F.when(n >= 500, n)
    return rt.exact_filter(t.documents, {
        "lang": rt.filter_value(F.when(F.col("lang") != "de", F.col("lang")), F.lit("en")),
        "period": rt.filter_period(start, start, F.lit(1000), F.lit(10**9)),
    }).select("doc_id", "filter_lang", "filter_period", "filter_state")


@query("q42_fuse_scores", """SELECT doc_id, round((CASE WHEN lang = 'en' THEN 0.5::DOUBLE * 0.9::DOUBLE ELSE 0::DOUBLE END + 0.3::DOUBLE * (n_chars / 30011::DOUBLE)
      + CASE WHEN quality IS NOT NULL THEN 0.2::DOUBLE * quality ELSE 0::DOUBLE END)
    / (CASE WHEN lang = 'en' THEN 0.5::DOUBLE ELSE 0::DOUBLE END + 0.3::DOUBLE + CASE WHEN quality IS NOT NULL THEN 0.2::DOUBLE ELSE 0::DOUBLE END), 6) AS score FROM documents LEFT JOIN labels USING (doc_id)""")
def fuse_scores(t: Tables):
    d = t.documents.join(t.labels, "doc_id", "left")
    s = rt.fuse_scores({"title": 0.5, "description": 0.3, "keywords": 0.2}, {
        "title": F.when(F.col("lang") == "en", F.lit(0.9)), "description": F.col("n_chars") / 30011.0,
        "keywords": F.col("quality").cast("double")})
    return d.select("doc_id", F.round(s, 6).alias("score"))


def _runs(t: Tables):
    """Documents of each source ranked by length, judged by their labels."""
    d = t.documents.select("source", "doc_id", "n_chars")
    res = rank_within(d, "source", [F.desc("n_chars"), "doc_id"]).select(
        F.col("source").alias("query_id"), F.col("doc_id").alias("id"), "rank")
    grade = F.when(F.col("quality") == 0, F.lit(0)).when(F.col("toxic") == 1, F.lit(1)).otherwise(F.lit(3))
    jud = t.labels.join(d, "doc_id").select(F.col("source").alias("query_id"), F.col("doc_id").alias("id"), grade.alias("grade"))
    return res, jud


_EVAL = """res AS (SELECT * FROM (SELECT source AS q, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents)),
  jud AS (SELECT source AS q, doc_id, CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 3 END AS grade FROM labels JOIN documents USING (doc_id)),
  hit AS (SELECT res.q, res.doc_id, rank, coalesce(grade, 0) AS grade FROM res LEFT JOIN jud ON jud.q = res.q AND jud.doc_id = res.doc_id),
  ideal AS (SELECT q, sum(grade / log2(p + 1)) AS idcg FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY grade DESC, doc_id) AS p FROM jud WHERE grade > 0) WHERE p <= 10 GROUP BY q),
  tot AS (SELECT q, count(*) FILTER (grade > 0) AS relevant FROM jud GROUP BY q),
  got AS (SELECT q, count(*) FILTER (grade > 0 AND rank <= 5) AS h5, count(*) FILTER (grade > 0 AND rank <= 10) AS h10,
    sum(CASE WHEN rank <= 10 THEN grade / log2(rank + 1) END) AS dcg, min(CASE WHEN grade > 0 THEN rank END) AS first FROM hit GROUP BY q),
  m AS (SELECT q, relevant, h5 / relevant::DOUBLE AS r5, h10 / relevant::DOUBLE AS r10, h5 / 5.0 AS p5, dcg / idcg AS ndcg, coalesce(1.0 / first, 0) AS rr
    FROM tot LEFT JOIN got USING (q) LEFT JOIN ideal USING (q))"""


@query("q43_eval_metrics", f"""WITH {_EVAL} SELECT q AS query_id, relevant, round(r5, 6) AS recall_at_5, round(r10, 6) AS recall_at_10, round(p5, 6) AS precision_at_5,
  round(ndcg, 6) AS ndcg_at_10, round(rr, 6) AS reciprocal_rank FROM m""")
def eval_metrics(t: Tables):
    m = ev.query_metrics(*_runs(t))
    return m.select("query_id", "relevant", *[F.round(c, 6).alias(c) for c in m.columns[2:]])


@query("q45_slices", f"""WITH {_EVAL} SELECT CASE WHEN relevant > 12 THEN 'many' ELSE 'few' END AS slice, count(*) AS queries, round(avg(r5), 6) AS recall_at_5,
  round(avg(ndcg), 6) AS ndcg_at_10, round(avg(rr), 6) AS mrr FROM m GROUP BY 1""")
def slices(t: Tables):
    m = ev.query_metrics(*_runs(t)).withColumn("slice", F.when(F.col("relevant") > 12, F.lit("many")).otherwise(F.lit("few")))
    s = ev.mean_metrics(m, ["slice"])
    return s.select("slice", "queries", *[F.round(c, 6).alias(c) for c in ("recall_at_5", "ndcg_at_10", "mrr")])


@query("q44_micro_macro_f1", """WITH p AS (SELECT doc_id, CASE WHEN n_chars > 1500 THEN 'good' ELSE 'poor' END AS l FROM documents SEMI JOIN labels USING (doc_id)
    UNION SELECT doc_id, 'toxic' FROM documents SEMI JOIN labels USING (doc_id) WHERE lang <> 'en'),
  tr AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS l FROM labels UNION SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1),
  c AS (SELECT l, count(*) FILTER (p.doc_id IS NOT NULL AND tr.doc_id IS NOT NULL) AS tp, count(*) FILTER (tr.doc_id IS NULL) AS fp, count(*) FILTER (p.doc_id IS NULL) AS fn
    FROM p FULL JOIN tr USING (doc_id, l) GROUP BY l)
  SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn, round(2.0 * sum(tp) / (2.0 * sum(tp) + sum(fp) + sum(fn)), 6) AS micro_f1,
    round(avg(coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0)), 6) AS macro_f1 FROM c""")
def micro_macro_f1(t: Tables):
    judged = t.documents.join(t.labels, "doc_id", "left_semi")
    p = judged.select(F.col("doc_id").alias("id"), F.when(F.col("n_chars") > 1500, F.lit("good")).otherwise(F.lit("poor")).alias("label")).unionAll(
        judged.filter("lang <> 'en'").select("doc_id", F.lit("toxic")))
    tr = t.labels.select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, F.lit("good")).otherwise(F.lit("poor")).alias("label")).unionAll(
        t.labels.filter("toxic = 1").select("doc_id", F.lit("toxic")))
    f = ev.f1_scores(ev.class_counts(p, tr))
    return f.select("tp", "fp", "fn", F.round("micro_f1", 6).alias("micro_f1"), F.round("macro_f1", 6).alias("macro_f1"))


@query("q114_changed_inputs", """SELECT doc_id FROM documents WHERE n_chars < 500 OR lang = 'fr'""")
def changed_inputs(t: Tables):
    d = t.spread("documents").withColumn("input_hash", fingerprint(text=F.col("text"), lang=F.col("lang")))
    old = t.documents.filter("n_chars >= 500").withColumn("input_hash", fingerprint(
        text=F.col("text"), lang=F.when(F.col("lang") != "fr", F.col("lang"))))
    return rt.changed_inputs(d, old, ["doc_id"], "input_hash").select("doc_id")


_CHANNELS = f"""{_CENTROID}, a AS (SELECT q, vec_id, s FROM sc WHERE s >= 0.2), b AS (SELECT q, vec_id, s FROM sc WHERE label = q),
  ch AS (SELECT q, vec_id, s, 'metadata' AS c FROM a UNION ALL SELECT q, vec_id, least(0.9, s), 'concept' FROM b),
  merged AS (SELECT q, vec_id, max(s) AS s, string_agg(c, ',' ORDER BY c) AS channels FROM ch GROUP BY 1, 2)"""


def _channels(t: Tables):
    direct = _concept_scores(t, 0.2).select(F.col("concept_id").alias("query_id"), F.col("dataset_id").alias("id"), "score")
    linked = _own_scores(t)
    q = t.embeddings.select(F.col("label").alias("query_id")).distinct().select("query_id", F.col("query_id").alias("concept_id"), F.lit(0.9).alias("score"))
    return rt.merge_channels(metadata=direct, concept=rt.concept_channel(q, linked))


@query("q115_channels", f"""WITH {_CHANNELS} SELECT q AS query_id, vec_id AS id, round(s, 6) AS score, channels FROM merged""")
def channels(t: Tables):
    return _channels(t).select("query_id", "id", F.round("score", 6).alias("score"), F.array_join("channels", ",").alias("channels"))


@query("q116_retrieve", f"""WITH {_CHANNELS}, md AS (SELECT doc_id AS vec_id, lang, source, min(n_chars) AS n_chars FROM documents GROUP BY ALL),
  r AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY s DESC, vec_id) AS INTEGER) AS rank FROM merged JOIN md USING (vec_id) WHERE lang <> 'fr')
  SELECT q AS query_id, vec_id AS id, rank, source, CASE WHEN lang = 'de' THEN 'unknown' ELSE 'match' END AS filter_state, channels,
    'result-' || substr(sha256(q || chr(31) || vec_id), 1, 20) AS retrieval_result_id FROM r WHERE rank <= 5""")
def retrieve(t: Tables):
    lang = F.col("lang")
    md = t.documents.select(F.col("doc_id").alias("id"), "lang", "source", "n_chars")
    out = rt.retrieve(_channels(t), md, {"lang": rt.filter_value(
        F.when(lang == "fr", F.lit("other")).when(lang != "de", F.lit("wanted")), F.lit("wanted"))}, 5)
    return out.select("query_id", "id", "rank", "source", "filter_state", F.array_join("channels", ",").alias("channels"), "retrieval_result_id")


@query("q117_lexical_baseline", """WITH q AS (SELECT DISTINCT p_type AS query_id, unnest(list_distinct([lower(p_type), 'bolt', 'red'])) AS token FROM part),
  tt AS (SELECT p_partkey AS id, unnest(list_distinct(string_split(p_name, ' '))) AS token FROM part),
  h AS (SELECT query_id, id, count(*) AS overlap FROM tt JOIN q USING (token) GROUP BY 1, 2)
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, id) AS INTEGER) AS rank FROM h) WHERE rank <= 10""")
def lexical_baseline(t: Tables):
    q = t.part.select(F.col("p_type").alias("query_id"), F.concat(F.col("p_type"), F.lit(" Red, bolt!")).alias("text")).distinct()
    return rt.lexical_baseline(q, t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title")), 10)


@query("q118_abstention", """SELECT round(sum(CASE WHEN n_chars < 500 THEN 1 ELSE 0 END)::DOUBLE / sum(CASE WHEN lang = 'fr' THEN 0 ELSE 2 END), 6) AS required_filter_error_rate,
  round(count(*) FILTER (lang IN ('fr') AND n_chars > 0)::DOUBLE / count(*) FILTER (lang IN ('fr', 'de')), 6) AS no_answer_abstention_rate FROM documents""")
def abstention(t: Tables):
    lang = F.col("lang")
    runs = t.documents.select(F.col("doc_id").alias("query_id"), (~lang.isin("fr", "de")).alias("answerable"),
                              F.when(lang == "fr", F.lit(0)).otherwise(F.lit(2)).alias("returned"),
                              F.when(F.col("n_chars") < 500, F.lit(1)).otherwise(F.lit(0)).alias("conflicts"))
    m = ev.filter_and_abstention(runs)
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


_FAM = """sha256(lower(trim(regexp_replace(text, '[\\s\\p{Z}\\x{0b}\\x{1c}-\\x{1f}\\x{85}]+', ' ', 'g'))))"""


@query("q119_family_split", f"""SELECT doc_id, f AS family, CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'dev' ELSE 'test' END AS split
  FROM (SELECT doc_id, f, CAST('0x' || substr(f, 1, 8) AS BIGINT) % 100 AS b FROM (SELECT doc_id, {_FAM} AS f FROM documents))""")
def family_split(t: Tables):
    return ev.family_split(t.spread("documents"), "text").select("doc_id", "family", "split")


@query("q27_hash_groups", f"""SELECT {_FAM} AS family, count(*) AS copies, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1""")
def hash_groups(t: Tables):
    g = ev.family_split(t.spread("documents"), "text").groupBy("family").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc"))
    return g.filter("copies > 1")


@query("q120_judge_agreement", """SELECT count(*) AS items, count(*) FILTER (quality = toxic) AS agreed, round(avg((quality = toxic)::INT), 6) AS agreement FROM labels""")
def judge_agreement(t: Tables):
    both = F.inline(F.array(F.struct(F.lit("a").alias("judge"), F.col("quality").alias("grade")), F.struct(F.lit("b").alias("judge"), F.col("toxic").alias("grade"))))
    s, _ = ev.judge_agreement(t.labels.select(F.lit(1).alias("query_id"), F.col("doc_id").alias("id"), both))
    return s.withColumn("agreement", F.round("agreement", 6))


@query("q121_retrieval_log", """SELECT sha256(source) AS query_hash, doc_id AS id, CAST(n_chars AS INTEGER) AS rank, lang AS filter_state, '0.5' AS policy_version FROM documents""")
def retrieval_log(t: Tables):
    d = t.documents.select(F.col("source").alias("query_id"), F.col("source").alias("query_text"), F.col("doc_id").alias("id"),
                           F.col("n_chars").cast("int").alias("rank"), F.lit(0.5).alias("score"), F.col("lang").alias("filter_state"))
    return ev.retrieval_log(d, "0.5").drop("score", "logged_at")


@query("q182_pruned_knn", """WITH n AS (SELECT a.vec_id AS query_id, b.vec_id AS id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s
    FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0),
  r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, id) AS INTEGER) AS rank FROM n)
  SELECT query_id, id, round(s, 6) AS score, rank FROM r WHERE rank <= 10""")
def pruned_knn(t: Tables):
    corpus = _corpus(t)
    asked = corpus.filter(F.col("id") % 100 == 0).withColumnRenamed("id", "query_id")
    return pk.pruned_knn(asked, pk.build_cells(corpus), 10).rows.withColumn("score", F.round("score", 6))
