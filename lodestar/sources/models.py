"""Saved description-search models (M1, M2, M3, E4): vocabulary, idf, components and projected documents as published tables.

A model is fitted once by a batch job and published (``versions``). Requests are folded in: their words are weighted by the saved
idf and projected by the saved components, and no fit is part of that plan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import lsa as L
from lodestar.operators import tfidf as TF
from lodestar.operators.dense import dense_cosine_topk
from lodestar.sources.versions import Layout, current, publish, read_version


@dataclass
class DescriptionModel:
    tfidf: TF.TfidfModel
    lsa: L.LsaModel
    titles: DataFrame  # seed_id, title, descr


def fit_descriptions(seeds: DataFrame, k: int = 50, passes: int = 5, seed: int = 0, exact: bool = False) -> DescriptionModel:
    """TF-IDF (vectoriser defaults) and truncated SVD of the seed descriptions; ``exact`` iterates to a tolerance."""
    model, vecs = TF.fit_transform(seeds)
    X = vecs.select("doc_id", "term", F.col("weight").alias("w"))
    if exact:
        from lodestar.operators.lanczos import fit_exact

        svd = fit_exact(X, k).model
    else:
        svd = L.fit(X, k, passes=passes, seed=seed)
    titles = seeds.select(F.col("id").alias("seed_id"), F.get(F.col("titles"), 0).alias("title"), F.col("description").alias("descr"))
    return DescriptionModel(model, svd, titles)


def save_descriptions(model: DescriptionModel, path: str) -> int:
    """Publish the model as one version; returns its number."""
    spark = model.titles.sparkSession
    sigma = spark.createDataFrame([(i + 1, float(s)) for i, s in enumerate(model.lsa.sigma)], "rank long, sigma double")
    tables = {"vocabulary": model.tfidf.idf, "components": model.lsa.components, "sigma": sigma, "documents": model.lsa.doc_vectors, "titles": model.titles}
    layouts = {"vocabulary": Layout(("term",)), "components": Layout(("term",)), "titles": Layout(("seed_id",))}
    about = {"n_docs": model.tfidf.n_docs, "stop_words": list(model.tfidf.stop_words) if model.tfidf.stop_words is not None else None}
    return publish(spark, path, tables, layouts, about).number


def load_descriptions(spark: SparkSession, path: str) -> DescriptionModel:
    version = current(spark, path)
    t = read_version(spark, path, version)
    sigma = np.array([r["sigma"] for r in t["sigma"].orderBy("rank").collect()])
    tfidf = TF.TfidfModel(t["vocabulary"], version.about["n_docs"], version.about["stop_words"])
    return DescriptionModel(tfidf, L.LsaModel(sigma, t["components"], t["documents"], len(sigma)), t["titles"])


def search_descriptions(model: DescriptionModel, requests: DataFrame, top: int = 5) -> DataFrame:
    """``(request_id, rank, seed_id, title, descr, score)`` of the ``top`` seeds nearest to each ``(request_id, input_text)``.

    A request with no known word projects to the zero vector (all scores 0).
    """
    rows = TF.transform(model.tfidf, requests, "request_id", "input_text").select("doc_id", "term", F.col("weight").alias("w"))
    zero = F.array_repeat(F.lit(0.0), model.lsa.k)
    asked = requests.select(F.col("request_id").alias("doc_id")).join(L.x_times(rows, model.lsa.components), "doc_id", "left")
    hits = dense_cosine_topk(asked.select("doc_id", F.coalesce("vec", zero).alias("vec")), model.lsa.doc_vectors, top, "doc_id", "vec", "doc_id", "vec")
    hits = hits.select(F.col("query_id").alias("request_id"), "rank", F.col("doc_id").alias("seed_id"), "score")
    return hits.join(model.titles, "seed_id").select("request_id", "rank", "seed_id", "title", "descr", "score")
