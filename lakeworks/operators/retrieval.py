"""Article records, nearest vectors, prompt contexts and source lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeworks.functions.vectors import squared_distance
from lakeworks.operators.chunking import CHUNK_SIZE, located_chunks
from lakeworks.operators.intervals import points_in_intervals
from lakeworks.operators.topk import best_per_task
from lakeworks.session import durable

# Link form of an article and the texts used where a part is absent.
ARTICLE_URL = "https://pubmed.ncbi.nlm.nih.gov/%s/"
NO_ABSTRACT = "No abstract available."
NO_TITLE = "No title"
NO_LINK = "No link"

# Sources listed per question, and chunks given to the answer (the usual default).
SOURCES_K = 3
CONTEXT_K = 4
CONTEXT_SEPARATOR = "\n\n"

# Up to this many hits are broadcast to the chunk table; more are joined by shuffle.
BROADCAST_HITS = 10_000


def article_documents(records: DataFrame) -> DataFrame:
    """(title, pmid, abstract parts) records to documents: joined abstract, title and link."""
    body = F.coalesce(F.array_join("abstract", " "), F.lit(NO_ABSTRACT))
    link = F.format_string(ARTICLE_URL, F.col("pmid").cast("string"))
    return records.select(
        "pmid", body.alias("page_content"), F.struct(F.col("title").alias("title"), link.alias("source")).alias("metadata")
    )


def nearest(
    vectors: DataFrame, questions: DataFrame, k: int = SOURCES_K, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The k nearest vectors per question: question_id, key, distance, rank.

    Exact. Each task reads its vectors in blocks and keeps the k best per question, without a row per pair; only these
    are shuffled and ranked. Ties go by key. Vectors that are null, not finite or of another length take no part.
    """
    order = W.partitionBy("question_id").orderBy("distance", key)
    best = best_per_task(vectors, questions, k, key, vector)
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_to(
    vectors: DataFrame, question: list[float], k: int = SOURCES_K, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The k nearest vectors of one question vector, as an ordered top-k."""
    distance = squared_distance(F.col(vector), F.array(*[F.lit(float(x)) for x in question]))
    return vectors.select(key, distance.alias("distance")).orderBy("distance", key).limit(k)


def _hits(hits: DataFrame, key: str) -> DataFrame:
    """Hits settled once (so that the search does not run again), broadcast if there are few."""
    settled = durable(hits.select("question_id", "rank", key))
    return F.broadcast(settled) if settled.count() <= BROADCAST_HITS else settled


def topic_questions(vectors: DataFrame, topic: str = "label", vector: str = "embedding") -> DataFrame:
    """One question per topic: the mean vector of its rows, as question_id and question_vector."""
    parts = vectors.filter(F.col(topic).isNotNull()).select(topic, F.posexplode(vector).alias("i", "x"))
    means = parts.groupBy(topic, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    # One entry per dimension.
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    mean = F.transform(ordered, lambda entry: entry["x"]).alias("question_vector")
    return means.groupBy(F.col(topic).alias("question_id")).agg(mean)


def _ranked_texts(text: Column) -> Column:
    """Texts of one question in rank order; the list is as long as k."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", text.alias("text"))))
    return F.transform(ordered, lambda x: x["text"])


def _places_of(hits: DataFrame, places: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Hits with the document and the place their vector stands for, and the documents they are in."""
    few = _hits(hits, key)
    located = durable(few.join(places, key))
    named = located.select("doc_id").distinct()
    return located, F.broadcast(named) if located.count() <= BROADCAST_HITS else named


def context_chunks(hits: DataFrame, places: DataFrame, docs: DataFrame, key: str = "vec_id") -> DataFrame:
    """question_id, rank, doc_id, start, end, chunk_text: the first chunk that holds each hit's place.

    ``places`` gives doc_id and place (a character offset) per key, ``docs`` doc_id and text. Only documents that were hit are
    cut, and chunks meet hits by (document, stretch of text), so many hits in one long document are spread as well.
    """
    located, hit_docs = _places_of(hits, places, key)
    chunks = located_chunks(docs.select("doc_id", "text").join(hit_docs, "doc_id", "left_semi"))
    found = points_in_intervals(located, chunks, "doc_id", "place", "start", "end", CHUNK_SIZE)
    first = found.groupBy("question_id", "rank", "doc_id").agg(F.min(F.struct("start", "end", "chunk_text")).alias("chunk"))
    return first.select("question_id", "rank", "doc_id", "chunk.*")


def chunk_contexts(hits: DataFrame, places: DataFrame, docs: DataFrame, key: str = "vec_id") -> DataFrame:
    """The chunks of each question's hits, joined in rank order; hits without text leave no gap."""
    chunks = context_chunks(hits, places, docs, key)
    texts = chunks.groupBy("question_id").agg(F.array_join(_ranked_texts(F.col("chunk_text")), CONTEXT_SEPARATOR).alias("context"))
    asked = hits.select("question_id").distinct()
    return asked.join(texts, "question_id", "left").select("question_id", F.coalesce("context", F.lit("")).alias("context"))


def contexts(hits: DataFrame, chunks: DataFrame, key: str = "vec_id", text: str = "chunk_text") -> DataFrame:
    """The retrieved chunk texts of each question, joined in rank order; hits without text leave no gap."""
    found = _hits(hits, key).join(chunks.select(key, text), key, "left")
    return found.groupBy("question_id").agg(F.array_join(_ranked_texts(F.col(text)), CONTEXT_SEPARATOR).alias("context"))


def source_list(hits: DataFrame, sources: DataFrame, key: str = "vec_id") -> DataFrame:
    """Sources of each question in order of first appearance, one row per link."""
    settled = _hits(hits, key)
    known = sources.select(key, "title", "source").join(settled, key)
    unknown = settled.join(known.select("question_id", key), ["question_id", key], "left_anti")
    found = known.unionByName(unknown, allowMissingColumns=True)
    named = found.select(
        "question_id",
        "rank",
        F.coalesce("title", F.lit(NO_TITLE)).alias("title"),
        F.coalesce("source", F.lit(NO_LINK)).alias("source"),
    )
    first = named.groupBy("question_id", "source").agg(F.min(F.struct("rank", "title")).alias("first"))
    return first.select(
        "question_id", F.col("first.rank").alias("rank"), F.col("first.title").alias("title"), "source"
    ).orderBy("question_id", "rank")
