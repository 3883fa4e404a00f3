"""End-to-end pipelines (E1-E9) built from the operators; all take and return DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions.text import default_stop_words
from lodestar.operators import blockmax
from lodestar.operators import fuzzy as FZ
from lodestar.operators import rank as R
from lodestar.operators import search as S
from lodestar.operators import tags as T
from lodestar.operators import tfidf as TF
from lodestar.operators.index import build_index, query_terms
from lodestar.operators.similarity import KEYWORDS, TOP_K, similar_documents
from lodestar.session import materialize
from lodestar.sources import views


def stop_list(stop_words: Sequence[str] | None) -> Sequence[str]:
    return default_stop_words("english") if stop_words is None else stop_words


def top_similar(
    works: DataFrame,
    seeds: DataFrame,
    k: int = TOP_K,
    n_keywords: int = KEYWORDS,
    stop_words: Sequence[str] | None = None,
    strategy: str = "auto",
    min_df: int = 10,
    max_df_ratio: float = 0.95,
) -> DataFrame:
    """Minimum slice: T1 -> A1-A6 -> J1/A7/J2 -> K1 -> K2 on (works, seeds).

    ``strategy``: those of ``similarity.term_matches``, or ``block_max`` (postings that cannot matter are not scored).
    """
    sw = stop_list(stop_words)
    index = build_index(works, "id", "description", stop_words=sw, min_df=min_df, max_df_ratio=max_df_ratio)
    qterms = query_terms(seeds, index.idf, "id", "description", stop_words=sw)
    if strategy == "block_max":
        return blockmax.similar_documents(index, qterms, k, n_keywords)
    return similar_documents(index, qterms, k, n_keywords, strategy=strategy)


def top50_per_seed(spark: SparkSession, sf_dir: str, strategy: str = "auto") -> DataFrame:
    """Flagship: the 50 most similar works per seed, with the 5 terms that explain each match."""
    return top_similar(views.works(spark, sf_dir), views.seeds(spark, sf_dir), strategy=strategy)


def tag_vocabulary(seeds: DataFrame, works: DataFrame, num_tags: int = T.NUM_TAGS, stop_words: Sequence[str] | None = None) -> DataFrame:
    """P10 -> T3 -> A11 -> K8."""
    corpus = T.combine_corpora(seeds, works)
    return T.tag_vocabulary(T.tag_document_frequency(corpus, stop_list(stop_words)), num_tags)


def build_recommendations(
    seeds: DataFrame,
    works: DataFrame,
    num_tags: int = T.NUM_TAGS,
    k: int = TOP_K,
    n_keywords: int = KEYWORDS,
    stop_words: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Tag vocabulary -> restrict works -> index -> all-pairs cosine -> top-k + keywords.

    Returns the bundle tables: recs, works_dim (with popularity), seeds_dim, tag_vocab.
    """
    vocab = materialize(tag_vocabulary(seeds, works, num_tags, stop_words))
    kept = T.restrict_to_vocab(works, vocab)
    recs = top_similar(kept, seeds, k, n_keywords, stop_words)
    works_dim = kept.withColumn("popularity", views.popularity(F.col("hits"), F.col("kudos"), F.col("chapters")))
    seeds_dim = seeds.select("id", "titles", F.get(F.col("titles"), 0).alias("title"), "description", "authors", "genres", "tags")
    return {"recs": recs, "works_dim": works_dim, "seeds_dim": seeds_dim, "tag_vocab": vocab}


def recommend(
    recs: DataFrame,
    works_dim: DataFrame,
    seeds_dim: DataFrame,
    requests: DataFrame,
    num_fics: int = R.NUM_FICS,
    filter_first: bool = False,
    lookup: DataFrame | None = None,
    max_popularity: float | None = None,
) -> DataFrame:
    """requests(request_id, title, popularity_weight, tags array) ->
    title -> seed (last wins) -> first ``num_fics`` by cosine -> blend -> assemble -> tag filter.

    As in the reference the tag filter runs after the slice, so a request may get fewer
    than ``num_fics`` rows; ``filter_first=True`` filters the candidates first instead.
    ``lookup`` (title to seed) and ``max_popularity`` can be given where they are known.
    """
    lookup = R.seed_lookup(seeds_dim) if lookup is None else lookup
    req = requests.join(lookup, "title")
    pop = works_dim.select(F.col("id").alias("doc_id"), "popularity")
    wanted = req.select("request_id", F.col("tags").alias("wanted"))
    if filter_first:
        tags = works_dim.select(F.col("id").alias("doc_id"), "tags")
        per_req = req.select("request_id", "seed_id", "tags").join(recs, "seed_id").join(tags.withColumnRenamed("tags", "doc_tags"), "doc_id")
        kept = per_req.where(R.tags_any_match(F.col("doc_tags"), F.col("tags")))
        w = Window.partitionBy("request_id").orderBy(F.col("rank").asc())
        recs_req = kept.withColumn("rank", F.row_number().over(w).cast("long")).select(
            F.col("request_id").alias("seed_id"), "doc_id", "rank", "score", "keywords", "cosine"
        )
        ranked = R.blend_rerank(recs_req, pop, req.select("request_id", F.col("request_id").alias("seed_id"), "popularity_weight"), num_fics, max_popularity=max_popularity)
        return R.assemble(ranked, works_dim)
    ranked = R.blend_rerank(recs, pop, req.select("request_id", "seed_id", "popularity_weight"), num_fics, max_popularity=max_popularity)
    records = R.assemble(ranked, works_dim)
    return records.join(wanted, "request_id").where(R.tags_any_match(F.col("tags"), F.col("wanted"))).drop("wanted")


def seed_detail(seeds_dim: DataFrame, requests: DataFrame, max_genres: int = 4) -> DataFrame:
    """E5: F6 -> P8 -> P9: whole title list, description, first author, first genres."""
    lookup = R.seed_lookup(seeds_dim)
    j = requests.join(lookup, "title").join(seeds_dim.drop("title").withColumnRenamed("id", "seed_id"), "seed_id")
    return j.select(
        "request_id", "seed_id", "titles", F.col("description").alias("descr"),
        F.get(F.col("authors"), 0).alias("author"), F.slice(F.col("genres"), 1, max_genres).alias("genres"),
    )


def work_tags(works_dim: DataFrame, ids: DataFrame, with_found: bool = False) -> DataFrame:
    """F7 -> P11 for a table of requested ids. Unknown ids give no row, or with
    ``with_found`` a row with null tags and ``found = false`` (the reference raises)."""
    dim = works_dim.select(F.col("id").alias("fanfic_id"), "tags")
    if with_found:
        return ids.join(dim.withColumn("found", F.lit(True)), "fanfic_id", "left").fillna(False, subset=["found"])
    return ids.join(dim, "fanfic_id")


def title_search(titles: DataFrame, requests: DataFrame) -> DataFrame:
    """E3."""
    return S.title_search(titles, requests)


def fuzzy_title_search(titles: DataFrame, requests: DataFrame, top: int = FZ.FUZZY_TOP) -> DataFrame:
    """E9."""
    return FZ.fuzzy_title_search(titles, requests, top=top)


def cross_corpus_nearest(seeds: DataFrame, works: DataFrame, stop_words: Sequence[str] | None = None, k: int = 1) -> DataFrame:
    """One smooth TF-IDF vocabulary fitted on seeds + works; nearest work per seed."""
    sw = stop_list(stop_words)
    _, vecs = TF.fit_transform(_both_sides(seeds, works), stop_words=sw)
    # both sides' vectors come from the one fitted pass; the struct stays the key, so the documents'
    # partitioning serves the sums too
    hits = TF.sparse_cosine_topk(vecs.where(F.col("doc_id.side") == "s"), vecs.where(F.col("doc_id.side") == "w"), k)
    return hits.select(F.col("seed_id.id").alias("seed_id"), F.col("doc_id.id").alias("doc_id"), "rank", "score")


def _both_sides(seeds: DataFrame, works: DataFrame) -> DataFrame:
    """One corpus of two whose ids may collide: rows are keyed by (side, id)."""
    key = lambda side: F.struct(F.lit(side).alias("side"), F.col("id")).alias("id")
    return seeds.select(key("s"), "description").unionByName(works.select(key("w"), "description"))


# ---------------------------------------------------------------- LSA
def description_search(
    seeds: DataFrame,
    requests: DataFrame,
    k: int = 50,
    top: int = 5,
    passes: int = 5,
    seed: int = 0,
) -> DataFrame:
    """E4 in one go: fit on the seed descriptions, then search for ``requests`` (request_id, input_text).

    To serve, fit once with ``sources.models.fit_descriptions``, save, load and call ``search_descriptions``.
    """
    from lodestar.sources.models import fit_descriptions, search_descriptions

    return search_descriptions(fit_descriptions(seeds, k, passes, seed), requests, top)


def joint_lsa(
    seeds: DataFrame,
    works: DataFrame,
    k: int = 150,
    stop_words: Sequence[str] | None = None,
    passes: int = 3,
    seed: int = 0,
) -> DataFrame:
    """M5: one vocabulary and one SVD fitted on seeds + works; both sides projected and the
    nearest work per seed taken in LSA space. Output: seed_id, doc_id, score."""
    from lodestar.operators import lsa as L
    from lodestar.operators import sliced
    from lodestar.operators.dense import dense_cosine_topk

    both = _both_sides(seeds, works)
    kind = both.schema["id"].dataType["id"].dataType.simpleString()
    # a short text is kept in a third of a struct's bytes; there is a row of it for each term of a document
    key = F.concat("id.side", F.coalesce(F.col("id.id").cast("string"), F.lit("")))
    model, vecs = TF.fit_transform(both.select(key.alias("id"), "description"), stop_words=stop_list(stop_words))
    # the weights as counts, idf and norms: the matrix is moved and kept in a third of the bytes
    X = sliced.by_terms(vecs.select("doc_id", "term", F.col("tf").alias("n"), "norm"), model.idf.select("term", F.col("idf").alias("scale")))
    model.let_go()
    del model, vecs
    svd = L.fit(X, k, passes=passes, seed=seed, components=False)
    # the fitted documents are already projected: no second pass over either corpus
    own = F.expr(f"try_cast(nullif(substring(doc_id, 2), '') as {kind})").alias("doc_id")
    side = lambda x: svd.doc_vectors.where(F.col("doc_id").startswith(x)).select(own, "vec")
    sv, wv = side("s"), side("w")
    hits = dense_cosine_topk(sv, wv, 1, "doc_id", "vec", "doc_id", "vec")
    return hits.select(F.col("query_id").alias("seed_id"), "doc_id", "score")


def tag_matrix(seeds: DataFrame, works: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    """Works x tags TF-IDF over the combined corpus with the tag-vocabulary df bounds: (doc_id, term, w)."""
    from lodestar.functions.text import tag_tokens

    corpus = T.combine_corpora(seeds, works).select(
        F.concat(F.col("side"), F.lit(":"), F.col("id").cast("string")).alias("doc_id"), "tags"
    )
    sw = stop_list(stop_words)
    kept = T.tag_document_frequency(T.combine_corpora(seeds, works), sw)
    n = corpus.count()
    counts = corpus.select("doc_id", F.explode(tag_tokens(F.col("tags"), sw)).alias("term")).groupBy("doc_id", "term").agg(
        F.count(F.lit(1)).alias("tf")
    )
    idf = kept.select(F.col("tag").alias("term"), (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))
    from lodestar.session import broadcast_if_small

    idf_side, _ = broadcast_if_small(idf)
    raw = counts.join(idf_side, "term").select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("raw"))
    from pyspark.sql import Window

    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term", (F.col("raw") / norm).alias("w"))


def tag_svd(seeds: DataFrame, works: DataFrame, k: int = 235, passes: int = 5, seed: int = 0):
    """M6: SVD of the works x tags matrix; returns (model, tag embedding (term, vec), work embedding (doc_id, vec))."""
    from lodestar.operators import lsa as L

    X = tag_matrix(seeds, works)
    model = L.fit(X, k, passes=passes, seed=seed)
    return model, model.components, model.doc_vectors


def tag_svd_exact(seeds: DataFrame, works: DataFrame, k: int = 235, tolerance: float = 1e-8) -> tuple[DataFrame, DataFrame]:
    """M6 to a tolerance: the works x tags matrix and its residual table (rank, sigma, residual, orthogonality)."""
    from lodestar.operators import lanczos

    X = materialize(tag_matrix(seeds, works))
    return X, lanczos.residual_table(X, lanczos.fit_exact(X, k, tolerance))


def singular_triplets(seeds: DataFrame, k: int = 50, tolerance: float = 1e-8) -> DataFrame:
    """M2 / M7 to a tolerance: (rank, sigma, residual, orthogonality) of the seed TF-IDF matrix."""
    from lodestar.operators import lanczos

    _, vecs = TF.fit_transform(seeds)
    X = materialize(vecs.select("doc_id", "term", F.col("weight").alias("w")))
    return lanczos.residual_table(X, lanczos.fit_exact(X, k, tolerance))


def singular_spectrum(seeds: DataFrame, k: int = 50, passes: int = 5, seed: int = 0) -> DataFrame:
    """M7: (rank, sigma, energy = sigma^2 / ||X||_F^2) of the seed TF-IDF matrix."""
    from lodestar.operators import lsa as L

    _, vecs = TF.fit_transform(seeds)
    X = vecs.select("doc_id", "term", F.col("weight").alias("w"))
    svd = L.fit(X, k, passes=passes, seed=seed)
    fro = X.agg(F.sum(F.col("w") * F.col("w"))).first()[0] or 0.0
    pdf = L.spectrum(svd, float(fro))
    spark = seeds.sparkSession
    return spark.createDataFrame(pdf.astype({"rank": "int64"}), "rank long, sigma double, energy double")
