"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator / pipeline.

Every query reads the driver tables (or views Spark derives from them) in full; request
tables are derived from the data too. Floating outputs are rounded so two engines agree
on the printed value; arrays that feed a value comparison are emitted as joined strings.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lodestar.functions.text import letter_tokens, primary_title
from lodestar.operators import index as I
from lodestar.operators import rank as R
from lodestar.operators import search as S
from lodestar.operators import similarity as SIM
from lodestar.operators import tags as T
from lodestar.operators import tfidf as TF
from lodestar.operators.dense import centroids, dense_cosine_topk
from lodestar.plans import pipelines as P
from lodestar.sources import views
from lodestar.sources.keyed import keyed_load_last_wins
from lodestar.sources.tables import read_table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed request parameters of the registered serving queries.
BLEND_WEIGHTS = (0.0, 0.5, 1.0)
RECOMMEND_WEIGHT = 0.5
RECOMMEND_TAGS = "en,Quality_1,"
VOCAB_PART = "src1"
SEEDS_A_FILE = 50
FILTER_TAGS = "EN,quality_1"
POSTING_CHUNK = 1024


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn

    return deco


def _index(spark, sf_dir):
    sw = P.stop_list(None)
    works = views.works(spark, sf_dir)
    return I.build_index(works, "id", "description", stop_words=sw), sw


def _r(c, dp=6):
    return F.round(c, dp)


# ---------------------------------------------------------------- step 1: text, projections, sources
@register("tokenize_count")
def tokenize_count(spark, sf_dir):
    toks = letter_tokens(F.col("description"), P.stop_list(None))
    return views.works(spark, sf_dir).select(
        F.col("id").alias("doc_id"),
        F.size(toks).cast("long").alias("n_tokens"),
        F.size(F.array_distinct(toks)).cast("long").alias("n_distinct"),
        F.md5(F.array_join(toks, " ")).alias("tokens_md5"),
    )


@register("primary_title")
def primary_title_q(spark, sf_dir):
    return views.seeds(spark, sf_dir).select("id", primary_title(F.col("titles")).alias("primary_title"))


@register("popularity")
def popularity_q(spark, sf_dir):
    w = views.works(spark, sf_dir)
    return w.select("id", "hits", "kudos", "chapters", _r(views.popularity(F.col("hits"), F.col("kudos"), F.col("chapters"))).alias("popularity"))


@register("keyed_load_last_wins")
def keyed_last_wins_q(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    return keyed_load_last_wins(ev, "user_id", "event_id").select("user_id", "event_id", "event_type", "value")


@register("union_pages")
def union_pages_q(spark, sf_dir):
    s = views.seeds(spark, sf_dir).select(F.lit("seeds").alias("page"), "id", primary_title(F.col("titles")).alias("title"))
    w = views.works(spark, sf_dir).select(F.lit("works").alias("page"), "id", "title")
    return s.unionByName(w)


@register("index_maps")
def index_maps_q(spark, sf_dir):
    t = views.titles(spark, sf_dir)
    return t.groupBy("title").agg(
        F.max("idx").alias("last_idx"), F.min("idx").alias("first_idx"), F.count(F.lit(1)).alias("n")
    )


@register("index_maps_both_ways")
def index_maps_both_ways_q(spark, sf_dir):
    """Id to index, index to id, title to index (the last work with that title) and index to title."""
    from lodestar.operators.keys import assign_dense_index

    w = assign_dense_index(views.works(spark, sf_dir).select("id", "title"), "id").select("id", "index", "title")
    row = lambda name, k, v: F.struct(F.lit(name).alias("map"), k.cast("string").alias("key"), v.cast("string").alias("value"))
    c = F.col
    maps = F.array(row("id_index", c("id"), c("index")), row("index_id", c("index"), c("id")), row("index_title", c("index"), c("title")))
    by_title = w.groupBy("title").agg(F.max("index").alias("index")).select(row("title_index", c("title"), c("index")).alias("r"))
    return w.select(F.explode(maps).alias("r")).union(by_title).select("r.*")


@register("slider_weight")
def slider_weight_q(spark, sf_dir):
    """The slider's text as a weight; text that is no whole number has none."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_size", "p_brand")
    return part.select("p_partkey", R.parse_weight(F.col("p_size").cast("string")).alias("weight"), R.parse_weight(F.col("p_brand")).alias("malformed"))


def _arrow_letter_tokens(stop_words):
    """U1 as an Arrow-native function: the default tokenizer, a batch at a time."""
    stop = pa.array(sorted(stop_words))

    @arrow_udf("array<string>")
    def tokens(text: pa.Array) -> pa.Array:
        # what is no letter ends a word; then words are kept that are not empty and not in the list
        lists = pc.split_pattern(pc.replace_substring_regex(text, "[^a-z]+", " "), " ")
        flat, of = pc.list_flatten(lists), pc.list_parent_indices(lists)
        keep = pc.and_(pc.not_equal(flat, ""), pc.invert(pc.is_in(flat, stop)))
        n = np.bincount(of.filter(keep).to_numpy(), minlength=len(text))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), flat.filter(keep))

    return lambda c: tokens(F.lower(F.coalesce(c, F.lit(""))))


@register("tokenizer_hook")
def tokenizer_hook_q(spark, sf_dir):
    """Document frequencies by the caller's own tokenizer, here one that works on Arrow batches."""
    idx = I.build_index(views.works(spark, sf_dir), "id", "description", tokenizer=_arrow_letter_tokens(P.stop_list(None)))
    return idx.doc_freq


@register("score_hook")
def score_hook_q(spark, sf_dir):
    """The caller's score of a term, here without the document's idf; the largest sums of each seed."""
    idx, sw = _index(spark, sf_dir)
    qt = I.query_terms(views.seeds(spark, sf_dir), idx.idf, stop_words=sw)
    m, _ = SIM.term_matches(idx, qt, score_fn=lambda tf, idf, qtf: tf * qtf * idf)
    return SIM.top_k_per_seed(SIM.cosine_scores(SIM.dot_scores(m), idx.norms, "dot")).select("seed_id", "doc_id", "rank", "score")


# ---------------------------------------------------------------- step 2: index
@register("term_frequency")
def term_frequency_q(spark, sf_dir):
    return I.term_frequency(views.works(spark, sf_dir), stop_words=P.stop_list(None))


@register("inverted_index")
def inverted_index_q(spark, sf_dir):
    """A2 packed postings, split into chunks of at most POSTING_CHUNK doc ids so no row is unbounded."""
    post = I.term_frequency(views.works(spark, sf_dir), stop_words=P.stop_list(None))
    chunked = post.withColumn("chunk", F.floor(F.col("doc_id") / POSTING_CHUNK).cast("long"))
    return chunked.groupBy("term", "chunk").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("doc_id", "tf"))),
                lambda s: F.concat(s["doc_id"].cast("string"), F.lit(":"), s["tf"].cast("string")),
            ),
            " ",
        ).alias("postings")
    )


@register("compact_postings")
def compact_postings_q(spark, sf_dir):
    """A2 in binary blocks: written, read back and decoded to the rows of ``inverted_index``."""
    from lodestar.operators import postings as C
    from lodestar.sources import io

    path = io.scratch_path(spark, "postings")
    C.compact(I.term_frequency(views.works(spark, sf_dir), stop_words=P.stop_list(None)), POSTING_CHUNK).write.parquet(path)
    rows = C.expand(spark.read.parquet(path), lists=True)  # a row is a whole block: nothing to gather
    entry = lambda s: F.concat(s["doc_id"].cast("string"), F.lit(":"), s["tf"].cast("string"))
    return rows.select("term", F.col("block").alias("chunk"), F.array_join(F.transform("postings", entry), " ").alias("postings"))


@register("document_frequency")
def document_frequency_q(spark, sf_dir):
    idx, _ = _index(spark, sf_dir)
    return idx.doc_freq


@register("idf_log2")
def idf_log2_q(spark, sf_dir):
    idx, _ = _index(spark, sf_dir)
    return idx.idf.select("term", "df", _r(F.col("idf")).alias("idf"))


@register("doc_norm")
def doc_norm_q(spark, sf_dir):
    idx, _ = _index(spark, sf_dir)
    return idx.norms.select("doc_id", _r(F.col("norm")).alias("norm"))


@register("query_norm")
def query_norm_q(spark, sf_dir):
    idx, sw = _index(spark, sf_dir)
    qt = I.query_terms(views.seeds(spark, sf_dir), idx.idf, stop_words=sw)
    return I.query_norms(qt).select("seed_id", _r(F.col("qnorm")).alias("qnorm"))


# ---------------------------------------------------------------- step 3: similarity
@register("dot_product")
def dot_product_q(spark, sf_dir):
    idx, sw = _index(spark, sf_dir)
    qt = I.query_terms(views.seeds(spark, sf_dir), idx.idf, stop_words=sw)
    m, _ = SIM.term_matches(idx, qt)
    scores = SIM.cosine_scores(SIM.dot_scores(m), idx.norms, "dot")  # the largest of each seed, not every pair
    return SIM.top_k_per_seed(scores).select("seed_id", "doc_id", F.col("score").alias("dot"))


RECS_COLS = ("seed_id", "doc_id", "rank", "score", "keywords")


@register("top50_per_seed")
def top50_per_seed(spark, sf_dir):
    return P.top50_per_seed(spark, sf_dir).select(*RECS_COLS)


@register("top50_term_shuffle")
def top50_term_shuffle(spark, sf_dir):
    """Same result as the flagship through the shuffled, hot-term-salted join strategy."""
    return P.top50_per_seed(spark, sf_dir, strategy="term_shuffle").select(*RECS_COLS)


@register("top50_block_max")
def top50_block_max(spark, sf_dir):
    """Same result as the flagship with postings passed over by the bounds of their terms and blocks."""
    return P.top50_per_seed(spark, sf_dir, strategy="block_max").select(*RECS_COLS)


@register("top5_keywords")
def top5_keywords_q(spark, sf_dir):
    return P.top50_per_seed(spark, sf_dir).select("seed_id", "doc_id", "keywords")


def _bundle(spark, sf_dir):
    return P.build_recommendations(views.seeds(spark, sf_dir), views.works(spark, sf_dir))


@register("build_recommendations")
def build_recommendations_q(spark, sf_dir):
    return _bundle(spark, sf_dir)["recs"].select(*RECS_COLS)


# ---------------------------------------------------------------- step 4: serving
@register("blend_rerank")
def blend_rerank_q(spark, sf_dir):
    b = _bundle(spark, sf_dir)
    weights = F.array(*[F.lit(w) for w in BLEND_WEIGHTS])
    req = b["seeds_dim"].select(F.col("id").alias("seed_id"), F.posexplode(weights).alias("wi", "popularity_weight"))
    req = req.withColumn("request_id", F.col("seed_id") * len(BLEND_WEIGHTS) + F.col("wi"))
    pop = b["works_dim"].select(F.col("id").alias("doc_id"), "popularity")
    out = R.blend_rerank(b["recs"], pop, req.select("request_id", "seed_id", "popularity_weight"))
    return out.join(req.select("request_id", "popularity_weight"), "request_id").select(
        "request_id", "seed_id", "popularity_weight", "doc_id", "rank", "cos_rank",
        _r(F.col("blended"), 4).alias("score"),
    )


def _recommend_requests(seeds_dim: DataFrame) -> DataFrame:
    return seeds_dim.select(
        F.col("id").alias("request_id"), F.col("title"),
        F.lit(RECOMMEND_WEIGHT).alias("popularity_weight"),
        R.parse_tag_param(F.lit(RECOMMEND_TAGS)).alias("tags"),
    ).where(F.col("title").isNotNull())


@register("recommend")
def recommend_q(spark, sf_dir):
    b = _bundle(spark, sf_dir)
    out = P.recommend(b["recs"], b["works_dim"], b["seeds_dim"], _recommend_requests(b["seeds_dim"]))
    return out.withColumn("tags", F.array_join("tags", ","))


@register("tags_any_match")
def tags_any_match_q(spark, sf_dir):
    w = views.works(spark, sf_dir)
    return w.where(R.tags_any_match(F.col("tags"), R.parse_tag_param(F.lit(FILTER_TAGS)))).select("id")


@register("seed_detail")
def seed_detail_q(spark, sf_dir):
    s = views.seeds(spark, sf_dir)
    sd = s.select("id", "titles", primary_title(F.col("titles")).alias("title"), "description", "authors", "genres")
    req = sd.select(F.col("id").alias("request_id"), "title").where(F.col("title").isNotNull())
    out = P.seed_detail(sd, req)
    return out.select(
        "request_id", "seed_id", F.array_join("titles", "|").alias("titles"), "descr", "author",
        F.array_join("genres", ",").alias("genres"),
    )


@register("work_tags")
def work_tags_q(spark, sf_dir):
    ids = read_table(spark, sf_dir, "labels", "doc_id").select(F.col("doc_id").alias("fanfic_id"))
    out = P.work_tags(views.works(spark, sf_dir), ids)
    return out.select("fanfic_id", F.array_join("tags", ",").alias("tags"))


# ---------------------------------------------------------------- step 5: searches
def _title_requests(spark, sf_dir) -> DataFrame:
    part = read_table(spark, sf_dir, "part", "p_name", "p_brand", "p_type")
    words = part.select(F.explode(F.split("p_name", " ")).alias("query"))
    return (
        words.unionByName(part.select(F.col("p_brand").alias("query")))
        .unionByName(part.select(F.col("p_type").alias("query")))
        .distinct()
        .select(F.col("query").alias("request_id"), "query")
    )


@register("title_search")
def title_search_q(spark, sf_dir):
    out = P.title_search(views.titles(spark, sf_dir), _title_requests(spark, sf_dir))
    return out.select(F.col("request_id").alias("query"), "title", "descr", "idx")


@register("title_search_top5")
def title_search_top5_q(spark, sf_dir):
    out = S.first_n(P.title_search(views.titles(spark, sf_dir), _title_requests(spark, sf_dir)))
    return out.select(F.col("request_id").alias("query"), "title", "idx", "pos")


@register("title_search_stored")
def title_search_stored_q(spark, sf_dir):
    """E3 from a published index that two loads of titles have made."""
    from lodestar.operators import title_index
    from lodestar.sources import io

    path, titles = io.scratch_path(spark, "title-index"), views.titles(spark, sf_dir)
    for load in (0, 1):
        title_index.publish_titles(spark, path, titles.where(F.col("idx") % 2 == load))
    out = title_index.search_index(title_index.load_index(spark, path), _title_requests(spark, sf_dir))
    return out.select(F.col("request_id").alias("query"), "title", "descr", "idx")


@register("fuzzy_title_search")
def fuzzy_title_search_q(spark, sf_dir):
    part = read_table(spark, sf_dir, "part", "p_name")
    near = part.select(F.expr("substring(p_name, 1, length(p_name) - 1)").alias("query"))
    far = read_table(spark, sf_dir, "part", "p_brand").select(F.reverse("p_brand").alias("query"))  # far from every title
    req = near.union(far).distinct()
    req = req.select(F.col("query").alias("request_id"), "query")
    out = P.fuzzy_title_search(views.titles(spark, sf_dir), req)
    return out.select(F.col("request_id").alias("query"), "rank", "idx", "title", "distance")


# ---------------------------------------------------------------- step 6: TF-IDF, tags, dense
@register("tfidf_smooth_l2")
def tfidf_smooth_l2_q(spark, sf_dir):
    _, vecs = TF.fit_transform(views.seeds(spark, sf_dir))
    return vecs.select("doc_id", "term", _r(F.col("weight")).alias("weight"))


@register("cross_corpus_nearest")
def cross_corpus_nearest_q(spark, sf_dir):
    return P.cross_corpus_nearest(views.seeds(spark, sf_dir), views.works(spark, sf_dir))


def _tag_corpus(spark, sf_dir):
    return T.combine_corpora(views.seeds(spark, sf_dir), views.works(spark, sf_dir))


@register("tag_document_frequency")
def tag_document_frequency_q(spark, sf_dir):
    return T.tag_document_frequency(_tag_corpus(spark, sf_dir), P.stop_list(None))


@register("tag_vocabulary")
def tag_vocabulary_q(spark, sf_dir):
    return P.tag_vocabulary(views.seeds(spark, sf_dir), views.works(spark, sf_dir))


@register("restrict_works_to_tag_vocab")
def restrict_q(spark, sf_dir):
    works = views.works(spark, sf_dir)
    vocab = P.tag_vocabulary(views.seeds(spark, sf_dir), works)
    # a part of the vocabulary, so that works go as well as stay
    return T.restrict_to_vocab(works, vocab.where(F.col("tag").startswith(VOCAB_PART))).select("id")


@register("restrict_works_whole_vocab")
def restrict_whole_q(spark, sf_dir):
    """F9 as the batch build uses it: the works with a tag of the whole vocabulary."""
    works = views.works(spark, sf_dir)
    return T.restrict_to_vocab(works, P.tag_vocabulary(views.seeds(spark, sf_dir), works)).select("id")


@register("dense_cosine_topk")
def dense_cosine_topk_q(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    q = centroids(emb, "label", "embedding")
    return dense_cosine_topk(q, emb, 5, "label", "centroid", "vec_id", "embedding")


# ---------------------------------------------------------------- step 7: LSA (rows-only checks)
def _description_requests(spark, sf_dir) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conv.where(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"), F.col("text").alias("input_text")
    )


@register("description_search")
def description_search_q(spark, sf_dir):
    return P.description_search(views.seeds(spark, sf_dir), _description_requests(spark, sf_dir))


def _saved_descriptions(spark, sf_dir):
    """The description model, fitted, published and read back."""
    from lodestar.sources import io, models

    path = io.scratch_path(spark, "description-model")
    models.save_descriptions(models.fit_descriptions(views.seeds(spark, sf_dir)), path)
    return models.load_descriptions(spark, path)


@register("description_search_saved")
def description_search_saved_q(spark, sf_dir):
    """E4 from the saved model."""
    from lodestar.sources.models import search_descriptions

    return search_descriptions(_saved_descriptions(spark, sf_dir), _description_requests(spark, sf_dir))


@register("tfidf_fold_in")
def tfidf_fold_in_q(spark, sf_dir):
    """M1 / M3: requests weighted by a saved vocabulary that was fitted on the seeds; unknown words have no weight."""
    from lodestar.sources.versions import Layout, current, publish, read_version
    from lodestar.sources import io

    path = io.scratch_path(spark, "vocabulary")
    fitted = TF.fit(views.seeds(spark, sf_dir))
    publish(spark, path, {"vocabulary": fitted.idf}, {"vocabulary": Layout(("term",))}, {"n_docs": fitted.n_docs})
    saved = TF.TfidfModel(read_version(spark, path)["vocabulary"], current(spark, path).about["n_docs"], None)
    rows = TF.transform(saved, _description_requests(spark, sf_dir), "request_id", "input_text")
    return rows.select("doc_id", "term", _r(F.col("weight")).alias("weight"))


@register("joint_lsa")
def joint_lsa_q(spark, sf_dir):
    return P.joint_lsa(views.seeds(spark, sf_dir), views.works(spark, sf_dir))


@register("tag_svd")
def tag_svd_q(spark, sf_dir):
    model, tags_emb, _ = P.tag_svd(views.seeds(spark, sf_dir), views.works(spark, sf_dir))
    return tags_emb.select(F.col("term").alias("tag"), F.transform("vec", lambda x: F.round(x, 6)).alias("embedding"))


@register("tag_svd_works")
def tag_svd_works_q(spark, sf_dir):
    """M6: the works' (and seeds') embedding of the same decomposition."""
    _, _, works_emb = P.tag_svd(views.seeds(spark, sf_dir), views.works(spark, sf_dir))
    return works_emb.select("doc_id", F.transform("vec", lambda x: F.round(x, 6)).alias("embedding"))


@register("singular_spectrum")
def singular_spectrum_q(spark, sf_dir):
    return P.singular_spectrum(views.seeds(spark, sf_dir))


SVD_TOLERANCE = 1e-6


@register("singular_triplets")
def singular_triplets_q(spark, sf_dir):
    """M2 exact: one row for each singular triplet of the seed TF-IDF matrix; does it have no residual, is it orthonormal."""
    t = P.singular_triplets(views.seeds(spark, sf_dir))
    return t.select("rank", (F.col("residual") < SVD_TOLERANCE).alias("solved"), (F.col("orthogonality") < SVD_TOLERANCE).alias("orthonormal"))


@register("tag_spectrum_moments")
def tag_spectrum_moments_q(spark, sf_dir):
    """M6 exact: the whole spectrum of the works x tags matrix by the sums of its squares and fourth powers."""
    _, t = P.tag_svd_exact(views.seeds(spark, sf_dir), views.works(spark, sf_dir))
    moment = lambda p: F.round(F.sum(F.pow("sigma", F.lit(p))), 4).alias(f"sum_{p}")
    return t.agg(moment(2), moment(4), (F.max("residual") < SVD_TOLERANCE).alias("solved"), (F.max("orthogonality") < SVD_TOLERANCE).alias("orthonormal"))


# ---------------------------------------------------------------- step 8: sources and sinks
@register("json_pages_roundtrip")
def json_pages_roundtrip_q(spark, sf_dir):
    """S1 + S3 + S4: works written as two JSON pages - every work with its base tags, then
    an update page for the labelled works with their full tags - read back with the
    fixed schema, unioned in page order and keyed by id with the later record winning."""
    from lodestar.sources import io

    works = views.works(spark, sf_dir)
    labelled = read_table(spark, sf_dir, "labels", "doc_id").withColumnRenamed("doc_id", "id")
    base = works.withColumn("tags", F.slice("tags", 1, 2))
    # inside the first page every id is there twice, the older record in the earlier files
    base = works.withColumn("tags", F.array(F.lit("older"))).withColumn("hits", F.lit(-1).cast("long")).unionByName(base)
    update = works.join(labelled, "id", "left_semi")
    root = io.scratch_path(spark, "pages")
    paths = [f"{root}/page1", f"{root}/page2"]
    io.write_pages(base, paths[0])
    io.write_pages(update, paths[1])
    loaded = io.read_works(spark, paths, multiline=False)
    # columns that are not asked for would be shuffled with their records
    latest = keyed_load_last_wins(loaded.select("id", "title", "tags", "hits", "load_seq"), "id", "load_seq")
    return latest.select("id", "title", F.array_join("tags", ",").alias("tags"), "hits")


@register("bundle_roundtrip")
def bundle_roundtrip_q(spark, sf_dir):
    """S5 + S6: the batch bundle written as Parquet and read back (recs shown)."""
    from lodestar.sources import io

    path = io.scratch_path(spark, "bundle")
    io.write_bundle(_bundle(spark, sf_dir), path)
    return io.read_bundle(spark, path)["recs"].select(*RECS_COLS)


def _seed_pages(spark, sf_dir) -> list[str]:
    """The seeds as the reference ships them: files that each hold one JSON array, two pages of folders; the id
    is kept as the rank."""
    from lodestar.sources import io

    s = views.seeds(spark, sf_dir)
    record = F.to_json(F.struct("titles", F.lit("en").alias("original_lang"), F.col("id").alias("rank"), "description", "authors", "genres", "tags"))
    rows = s.select((F.col("id") % 2).alias("page"), F.floor(F.col("id") / SEEDS_A_FILE).alias("file"), "id", record.alias("record"))
    files = rows.groupBy("page", "file").agg(
        F.concat(F.lit("["), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "record"))), lambda r: r["record"]), ",\n"), F.lit("]")).alias("value")
    )
    root = io.scratch_path(spark, "seed-pages")
    files.select("page", "file", "value").write.partitionBy("page", "file").text(root)
    return [f"{root}/page={p}/*" for p in (0, 1)]


@register("read_seeds")
def read_seeds_q(spark, sf_dir):
    """Seed pages of JSON array files, read in one scan."""
    from lodestar.sources import io

    loaded = io.read_seeds(spark, _seed_pages(spark, sf_dir))
    return loaded.select(F.col("rank").alias("id"), F.col("page").cast("long").alias("page"), F.get(F.col("titles"), 0).alias("title"), "description")


@register("read_seeds_split")
def read_seeds_split_q(spark, sf_dir):
    """S2 with record ends found inside the array files, so that one file can be many tasks."""
    from lodestar.sources import io
    from lodestar.sources.arrays import read_json_arrays

    loaded = read_json_arrays(spark, _seed_pages(spark, sf_dir), io.SEED_SCHEMA)
    return loaded.select(F.col("rank").alias("id"), F.col("page").cast("long").alias("page"), F.get(F.col("titles"), 0).alias("title"), "description")


@register("batch_from_pages")
def batch_from_pages_q(spark, sf_dir):
    """E1 whole: work and seed pages of JSON in, keyed loads, the batch, the bundle out (recs read back)."""
    from lodestar.sources import io

    root = io.scratch_path(spark, "pages")
    io.write_pages(views.works(spark, sf_dir), f"{root}/works")
    works = keyed_load_last_wins(io.read_works(spark, [f"{root}/works"], multiline=False).drop("page"), "id", "load_seq")
    seeds = io.read_seeds(spark, _seed_pages(spark, sf_dir)).drop("page").withColumn("id", F.col("rank"))
    seeds = keyed_load_last_wins(seeds, "id", "load_seq")
    io.write_bundle(P.build_recommendations(seeds, works), f"{root}/bundle")
    return io.read_bundle(spark, f"{root}/bundle")["recs"].select(*RECS_COLS)


@register("catalog_table")
def catalog_table_q(spark, sf_dir):
    """Typed catalog table created under a fresh name and filled from the seeds; the rows that fit, read back,
    and those that don't, whole."""
    from lodestar.sources import io

    name = io.create_catalog_table(spark, None, io.scratch_path(spark, "episodes"))
    s = views.seeds(spark, sf_dir).select(
        F.col("id").cast("int").alias("id"),
        primary_title(F.col("titles")).alias("title"),
        F.col("description").alias("descr"),
    )
    rejects = io.fill_catalog_table(s, name)
    return spark.table(name).withColumn("stored", F.lit(True)).unionByName(rejects.withColumn("stored", F.lit(False)))


# ---------------------------------------------------------------- step 9: streaming serving
@register("recommend_stream")
def recommend_stream_q(spark, sf_dir):
    """E2 as a stream: request files (derived from the seeds) drained through foreachBatch
    against the bundle persisted by the batch build; answers read back from the sink."""
    from lodestar.sources import io
    from lodestar.streaming.serve import serve_requests

    root = io.scratch_path(spark, "serve")
    io.write_bundle(_bundle(spark, sf_dir), f"{root}/bundle")
    bundle = io.read_bundle(spark, f"{root}/bundle")
    req = bundle["seeds_dim"].where(F.col("title").isNotNull()).select(
        F.col("id").alias("request_id"), "title",
        F.lit(RECOMMEND_WEIGHT).alias("popularity_weight"), F.lit(RECOMMEND_TAGS).alias("tags"),
    )
    req.write.mode("overwrite").json(f"{root}/requests")
    q = serve_requests(spark, f"{root}/requests", bundle, f"{root}/answers", f"{root}/_checkpoint")
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/answers").drop("batch_id")
    return out.withColumn("tags", F.array_join("tags", ","))


@register("assign_input_index")
def assign_input_index_q(spark, sf_dir):
    """P3 in input order: works in two pages, each in an order of its own, numbered as they are read."""
    from lodestar.operators.keys import assign_input_index
    from lodestar.sources import io

    works, root = views.works(spark, sf_dir).select("id", "title"), io.scratch_path(spark, "pages")
    io.write_pages(works.where("id % 2 = 0").orderBy(F.col("id").desc()), f"{root}/even")
    io.write_pages(works.where("id % 2 = 1").orderBy(F.col("id") % 10, "id"), f"{root}/odd")
    loaded = io.read_works(spark, [f"{root}/even", f"{root}/odd"], multiline=False)
    return assign_input_index(loaded).select("id", "index")


@register("assign_dense_index")
def assign_dense_index_q(spark, sf_dir):
    """Works numbered 0..n-1 in id order (the reference's positional index)."""
    from lodestar.operators.keys import assign_dense_index

    w = views.works(spark, sf_dir).select("id", "title")
    return assign_dense_index(w, "id").select("id", "index")
