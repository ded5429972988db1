"""Batch retrieval: the most relevant documents for many requests at once.

``kb_search`` ranks documents for each query with BM25 over lower-cased
letter/digit tokens of the whole texts; ``kb_search_vec`` ranks vectors by
cosine similarity (one matrix product per batch of vectors). Both return
the top ``k`` per query and, for a query that matches nothing, one row
carrying the fixed "nothing found" message instead of an invented answer.

Documents are the big side. They are read twice and never stored or shuffled:
once for the collection statistics, once to be scored in Arrow batches
against a block of queries of bounded size. Texts become arrays of 64-bit
token hashes in the JVM, and only those arrays reach Python, as flat buffers.
Within a batch each term adds an outer product of document and query weights,
so no row per (query, document, term) is ever created; a partition keeps a
running top ``k`` per query, and only those rows meet in the final ranking.
More queries than a block holds take more scans; the hits of a block are
written before the next block begins, so one block at a time is held.

``build_index`` and ``search_index`` are the same ranking over an inverted
index that is written once (``strata.operators.vectorcells`` is its
counterpart for vectors).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import tokens
from strata.operators.topk import top_k
from strata.session import checkpoint_dir

# Fixed value: the answer given when the knowledge base has nothing.
NOT_FOUND_MESSAGE = "Nenhuma informação institucional encontrada na base de conhecimento."

BM25_K1 = 1.2
BM25_B = 0.75
# Query rows (term weights or vectors) that one scan of the documents answers;
# more queries take more scans, each with a query side of this size.
QUERY_ROWS = 200_000
QUERY_BYTES = 64 << 20
_CELLS = 1 << 20  # scores held at a time: documents x queries
_TOKENS = 1 << 18  # tokens worked on at a time, or one document's


def _with_fallback(queries: DataFrame, hits: DataFrame, qid: str) -> DataFrame:
    out = queries.select(qid).join(hits, qid, "left")
    return out.withColumn("message", F.when(F.col("doc_id").isNull(), F.lit(NOT_FOUND_MESSAGE)))


def query_blocks(rows: DataFrame, most: int):
    """How many blocks ``rows`` (with ``qid``) make, and the blocks as pandas
    frames of about ``most`` rows, whole queries each: made one by one."""
    first = rows.limit(most + 1).toPandas()  # one block is the usual case, and one job
    if len(first) <= most:
        return min(1, len(first)), iter([first] if len(first) else [])
    blocks = -(-rows.count() // most)
    return blocks, (rows.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i).toPandas() for i in range(blocks))


def answered(spark: SparkSession, blocks: int, hits, schema) -> DataFrame:
    """The hits of all blocks: one block's stay lazy, of more each block's are
    written before the next block is fetched."""
    if blocks <= 1:
        return next(hits, None) or spark.createDataFrame([], schema)
    folder = f"{checkpoint_dir(spark)}/strata-hits-{uuid.uuid4().hex}"
    for part in hits:
        part.write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def written(df: DataFrame) -> DataFrame:
    """A few rows, written once to the shared folder."""
    return answered(df.sparkSession, 2, iter([df]), df.schema)


class Best:
    """Running top k per query over the rows of one partition."""

    def __init__(self, qids, k: int):
        self.qids, self.k = qids, k
        self.ids: list = [None] * len(qids)
        self.scores: list = [None] * len(qids)

    def add(self, j: int, ids, scores) -> None:
        import numpy as np

        if self.ids[j] is not None:
            ids, scores = np.concatenate((self.ids[j], ids)), np.concatenate((self.scores[j], scores))
        key = np.where(np.isnan(scores), np.inf, -scores)  # without a score: last
        if len(key) > 4 * self.k + 64:  # ties with the k-th stay
            near = np.flatnonzero(key <= np.partition(key, self.k - 1)[self.k - 1])
            ids, scores, key = ids[near], scores[near], key[near]
        pick = np.lexsort((_ranks(ids), key))[: self.k]
        self.ids[j], self.scores[j] = ids[pick], scores[pick]

    def batch(self, id_name: str, id_type):
        """The hits as an Arrow batch, ids of the type they came in; None without hits."""
        import numpy as np
        import pyarrow as pa

        some = [j for j, x in enumerate(self.ids) if x is not None]
        if not some:
            return None
        ids = np.concatenate([self.ids[j] for j in some])
        return pa.RecordBatch.from_pydict(
            {
                "qid": pa.array(np.concatenate([np.repeat(self.qids[j : j + 1], len(self.ids[j])) for j in some])),
                id_name: pa.array(ids.tolist() if ids.dtype == object else ids, id_type),
                "score": pa.array(np.concatenate([self.scores[j] for j in some]), from_pandas=True),  # NaN: none
            }
        )


def ids_of(column):
    """An Arrow id column as an array; with nulls, of Python objects."""
    import numpy as np

    return np.array(column.to_pylist() + [None], object)[:-1] if column.null_count else np.asarray(column)


def _ranks(ids):
    """Numbers in the order of ``ids`` (nulls first)."""
    import numpy as np

    if ids.dtype != object:
        return ids
    ranks = np.empty(len(ids), np.int64)
    ranks[sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] if ids[i] is not None else 0))] = np.arange(len(ids))
    return ranks


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out over all cores if it is so small that its scan would
    leave some idle (less than a scan partition a core); larger tables are
    read as they lie, without a shuffle."""
    sc = df.sparkSession.sparkContext
    scan = df.sparkSession.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")
    )
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(sc.defaultParallelism) if size < scan * sc.defaultParallelism else df


# ------------------------------------------------------------------ text ---
def hashed_tokens(text: str | Column) -> Column:
    """The tokens of a text as 64-bit hashes, in order."""
    return F.transform(tokens(text), lambda t: F.xxhash64(t))


def _query_terms(queries: DataFrame, qid: str, qtext: str) -> DataFrame:
    known = queries.select(F.col(qid).alias("qid"), F.col(qtext).alias("text")).filter("qid IS NOT NULL")
    rows = known.select("qid", F.explode(hashed_tokens("text")).alias("term"))
    return rows.groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf"))


def _term_side(block, df: dict[int, int], n_docs: int):
    """Query weights by term: the vocabulary (sorted hashes), and for term
    ``i`` the query columns ``cols[ptr[i]:ptr[i+1]]`` with their weights."""
    import numpy as np

    q = block[block["term"].isin(df.keys())].sort_values(["term", "qid"], kind="stable")
    counts = q["term"].map(df).to_numpy(dtype="float64")
    weights = q["qtf"].to_numpy(dtype="float64") * np.log(1.0 + (n_docs - counts + 0.5) / (counts + 0.5))
    qids = np.sort(q["qid"].unique())
    vocab, starts = np.unique(q["term"].to_numpy(np.int64), return_index=True)
    return qids, vocab, np.r_[starts, len(q)], np.searchsorted(qids, q["qid"].to_numpy()), weights


def _lookup(vocab, terms):
    """Place of every term in the sorted vocabulary, and which are in it."""
    import numpy as np

    at = np.searchsorted(vocab, terms)
    at[at == len(vocab)] = 0
    return at, (vocab[at] == terms) if len(vocab) else np.zeros(len(terms), bool)


def _score_into(best: Best, side, ids, doc, term, tf, length, avgdl: float) -> None:
    """Adds the BM25 scores of ``len(ids)`` documents; posting ``i`` says that
    vocabulary term ``term[i]`` stands ``tf[i]`` times in document ``doc[i]``
    of ``length[i]`` tokens."""
    import numpy as np

    qids, _, ptr, cols, weights = side
    order = np.argsort(term, kind="stable")
    doc, term, tf, length = doc[order], term[order], tf[order], length[order]
    w = tf * (BM25_K1 + 1) / (tf + BM25_K1 * ((1 - BM25_B) + BM25_B * length / (avgdl or 1.0)))
    scores = np.zeros((len(ids), len(qids)))
    cuts = np.flatnonzero(np.diff(term, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        lo, hi = ptr[term[a]], ptr[term[a] + 1]
        scores[np.ix_(doc[a:b], cols[lo:hi])] += np.outer(w[a:b], weights[lo:hi])
    matched = scores > 0  # every BM25 term weight is positive
    scores = np.round(scores, 9)
    for j in np.flatnonzero(matched.any(axis=0)):
        hit = np.flatnonzero(matched[:, j])
        best.add(j, ids[hit], scores[hit, j])


def _flat_tokens(batch):
    """Documents and tokens of an Arrow batch (doc_id, toks) without copies:
    ids, tokens per document, and all tokens in a row."""
    import numpy as np

    toks = batch.column("toks")
    sizes = np.asarray(toks.value_lengths().fill_null(0))
    return batch.column("doc_id"), sizes, np.asarray(toks.flatten())


def _runs(sizes, most: int):
    """Runs ``(a, b)`` of documents that cover ``sizes`` (tokens a document) in
    order: at most ``most`` documents and ``_TOKENS`` tokens, or one document."""
    import numpy as np

    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        fit = int(np.searchsorted(ends, ends[a] - sizes[a] + _TOKENS, side="right"))
        b = max(a + 1, min(a + most, fit))
        yield a, b
        a = b


def _statistics(vocab):
    """Per partition: in how many documents each vocabulary term stands, and
    (as terms null) the number of texts and tokens."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known, n, n_len, total = vocab.value, 0, 0, 0
        df = np.zeros(len(known), np.int64)
        for batch in batches:
            _, sizes, flat = _flat_tokens(batch)
            ends = np.cumsum(sizes)
            for a, b in _runs(sizes, len(sizes)):
                at, hit = _lookup(known, flat[ends[a] - sizes[a] : ends[b - 1]])
                pairs = np.unique(np.repeat(np.arange(b - a), sizes[a:b])[hit] * max(1, len(known)) + at[hit])
                df += np.bincount(pairs % max(1, len(known)), minlength=len(known))
            n, n_len = n + len(sizes), n_len + len(sizes) - batch.column("toks").null_count
            total += len(flat)
        some = np.flatnonzero(df)
        rows = [("docs", None, n), ("texts", None, n_len), ("tokens", None, total)]
        rows += [("term", int(known[i]), int(df[i])) for i in some]
        kind, term, count = zip(*rows)
        yield pa.RecordBatch.from_pydict(
            {"kind": pa.array(kind), "term": pa.array(term, pa.int64()), "n": pa.array(count, pa.int64())}
        )

    return run


def _bm25_scan(side, k: int, avgdl: float):
    """Scores batches of documents (doc_id, toks) against one block of
    queries; a partition gives its top ``k`` per query."""

    def scan(batches):
        import numpy as np

        qids, vocab, *_ = known = side.value
        best, batch = Best(qids, k), None
        step = max(1, _CELLS // max(1, len(qids)))
        for batch in batches:
            column, sizes, flat = _flat_tokens(batch)
            ids, ends = ids_of(column), np.cumsum(sizes)
            for a, b in _runs(sizes, step):
                at, hit = _lookup(vocab, flat[ends[a] - sizes[a] : ends[b - 1]])
                pairs, tf = np.unique(
                    at[hit] * (b - a) + np.repeat(np.arange(b - a), sizes[a:b])[hit], return_counts=True
                )
                term, doc = np.divmod(pairs, b - a)
                _score_into(best, known, ids[a:b], doc, term, tf, sizes[a:b][doc], avgdl)
        out = best.batch("doc_id", column.type) if batch is not None else None
        if out is not None:
            yield out

    return scan


def _ranked(queries: DataFrame, hits: DataFrame, k: int, qid: str) -> DataFrame:
    best = top_k(hits, ["qid"], [F.col("score").desc(), F.col("doc_id").asc()], k)
    return _with_fallback(queries.select(F.col(qid).alias("qid")), best, "qid").select(
        F.col("qid").alias(qid), "rank", "doc_id", "score", "message"
    )


def kb_search(
    queries: DataFrame,
    docs: DataFrame,
    k: int = 3,
    qid: str = "qid",
    qtext: str = "text",
    doc_id: str = "doc_id",
    dtext: str = "text",
) -> DataFrame:
    """Top-``k`` documents per query: (qid, rank, doc_id, score, message).

    Two passes over the documents a block of queries, none of which stores or
    shuffles texts. The first counts lengths, and in how many documents each
    query term occurs; a partition sends one row a term. The second scores
    whole documents, and only the top ``k`` per query and partition are
    shuffled. Terms meet as 64-bit hashes. Every document row is a document of
    its own.
    """
    spark = docs.sparkSession
    d = spread(docs.select(F.col(doc_id).alias("doc_id"), F.col(dtext).alias("text")))
    d = d.select("doc_id", hashed_tokens("text").alias("toks"))
    terms = _query_terms(queries, qid, qtext)
    schema = f"qid {dict(terms.dtypes)['qid']}, doc_id {dict(d.dtypes)['doc_id']}, score double"
    n_blocks, blocks = query_blocks(terms, QUERY_ROWS)

    def hits():
        for block in blocks:
            vocab = spark.sparkContext.broadcast(block["term"].sort_values().unique())
            counted = d.mapInArrow(_statistics(vocab), "kind string, term long, n long")
            rows = counted.groupBy("kind", "term").agg(F.sum("n").alias("n")).collect()  # a row a query term
            totals = {r["kind"]: r["n"] for r in rows if r["kind"] != "term"}
            df = {r["term"]: r["n"] for r in rows if r["kind"] == "term"}
            side = spark.sparkContext.broadcast(_term_side(block, df, totals.get("docs", 0)))
            avgdl = totals.get("tokens", 0) / max(totals.get("texts", 0), 1)
            yield d.mapInArrow(_bm25_scan(side, k, avgdl), schema)

    return _ranked(queries, answered(spark, n_blocks, hits(), schema), k, qid)


# ----------------------------------------------------------- stored index ---
INDEX_BUCKETS = 64


def _bucket(term, buckets: int) -> Column:
    return F.pmod(term, F.lit(buckets)).cast("int")


def _postings_of(batches):
    """(doc, doc_id, term, tf, length) of batches of (doc, doc_id, toks): a
    document lies in one batch, so nothing has to be shuffled to count it."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        ids, sizes, flat = _flat_tokens(batch)
        docs, ends = batch.column("doc"), np.cumsum(sizes)
        for a, b in _runs(sizes, len(sizes)):
            owner = np.repeat(np.arange(a, b), sizes[a:b])
            terms = flat[ends[a] - sizes[a] : ends[b - 1]]
            order = np.lexsort((terms, owner))
            owner, terms = owner[order], terms[order]
            new = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(terms, prepend=0) != 0))
            tf = np.diff(np.r_[new, len(terms)])
            at = pa.array(owner[new])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": docs.take(at),
                    "doc_id": ids.take(at),
                    "term": pa.array(terms[new], pa.int64()),
                    "tf": pa.array(tf, pa.int64()),
                    "length": pa.array(sizes[owner[new]].astype(np.int64)),
                }
            )


def build_index(
    docs: DataFrame, path: str, doc_id: str = "doc_id", dtext: str = "text", buckets: int = INDEX_BUCKETS
) -> None:
    """Write an inverted index of whole texts under ``path``, once, for many
    sets of requests:

    * ``postings`` (term hash, document, count, length), a folder a bucket of
      the term hash, sorted by term and document inside;
    * ``terms`` (term hash, documents it stands in), in the same buckets;
    * ``totals`` (documents, texts, tokens), one row.

    Counts are made where a text is read. Postings are shuffled once, by
    ranges of (bucket, term, document), so a word that stands in a third of
    all documents is spread over many files. The documents are numbered by
    their place in the scan, so rows that share an id stay documents of their
    own.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col(doc_id).alias("doc_id"), F.col(dtext).alias("text"))
    d = spread(rows).select("doc", "doc_id", hashed_tokens("text").alias("toks"))
    types = dict(d.dtypes)
    postings = d.mapInArrow(_postings_of, f"doc long, doc_id {types['doc_id']}, term long, tf long, length long")
    placed = postings.withColumn("bucket", _bucket(F.col("term"), buckets))
    ranged = placed.repartitionByRange("bucket", "term", "doc").sortWithinPartitions("bucket", "term", "doc")
    ranged.write.partitionBy("bucket").parquet(f"{path}/postings")
    kept = _stored_postings(spark, path, types["doc_id"])
    terms = kept.groupBy("bucket", "term").agg(F.count(F.lit(1)).alias("df"))
    terms.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/terms")
    lengths = docs.select(tokens(dtext).alias("toks")).agg(
        F.count(F.lit(1)).alias("docs"),
        F.count("toks").alias("texts"),
        F.sum(F.when(F.col("toks").isNotNull(), F.size("toks"))).alias("tokens"),
        F.lit(buckets).alias("buckets"),
        F.lit(types["doc_id"]).alias("id_type"),  # a folder without rows has no files to tell it
    )
    lengths.write.parquet(f"{path}/totals")


def _stored_postings(spark: SparkSession, path: str, id_type: str) -> DataFrame:
    schema = f"doc long, doc_id {id_type}, term long, tf long, length long, bucket int"
    return spark.read.schema(schema).parquet(f"{path}/postings")


def _posting_scan(side, k: int, avgdl: float):
    """Scores sorted postings (doc, doc_id, term, tf, length): documents are
    whole when the next one begins."""

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        qids, vocab, *_ = known = side.value
        best, held = Best(qids, k), None
        step = max(1, _CELLS // max(1, len(qids)))

        def score(table) -> None:
            doc = np.asarray(table["doc"])
            first = np.flatnonzero(np.diff(doc, prepend=-1))
            ids, nth = ids_of(table["doc_id"].take(pa.array(first))), np.cumsum(np.diff(doc, prepend=doc[0]) != 0)
            term, tf, length = (np.asarray(table[c]) for c in ("term", "tf", "length"))
            for a in range(0, len(ids), step):
                some = slice(first[a], first[a + step] if a + step < len(ids) else len(doc))
                at, hit = _lookup(vocab, term[some])
                _score_into(
                    best, known, ids[a : a + step], nth[some][hit] - a, at[hit], tf[some][hit], length[some][hit], avgdl
                )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            doc = np.asarray(held["doc"])
            if not len(doc):
                continue
            whole = int(np.searchsorted(doc, doc[-1]))  # the last document may go on
            if whole:
                score(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            score(held)
        out = best.batch("doc_id", held.schema.field("doc_id").type) if held is not None else None
        if out is not None:
            yield out

    return scan


def index_postings(spark: SparkSession, path: str, terms) -> DataFrame:
    """The postings of some term hashes (at most ``QUERY_ROWS``): only their
    buckets are read."""
    totals = spark.read.parquet(f"{path}/totals").first()
    wanted = sorted({int(t) % totals["buckets"] for t in terms})
    some = spark.createDataFrame([(int(t),) for t in terms], "term long")
    kept = _stored_postings(spark, path, totals["id_type"]).filter(F.col("bucket").isin(wanted))
    return kept.join(F.broadcast(some), "term", "left_semi")


def search_index(
    spark: SparkSession, path: str, queries: DataFrame, k: int = 3, qid: str = "qid", qtext: str = "text"
) -> DataFrame:
    """``kb_search`` over a stored index (``build_index``). A block of queries
    reads the buckets of its terms only; their postings meet by document, are
    scored in sorted runs, and a partition sends its top ``k`` per query."""
    totals = spark.read.parquet(f"{path}/totals").first()
    terms = _query_terms(queries, qid, qtext)
    schema = f"qid {dict(terms.dtypes)['qid']}, doc_id {totals['id_type']}, score double"
    n_blocks, blocks = query_blocks(terms, QUERY_ROWS)

    def hits():
        for block in blocks:
            wanted = block["term"].unique()
            some = spark.createDataFrame([(int(t),) for t in wanted], "term long")
            inside = sorted({int(t) % totals["buckets"] for t in wanted})
            known = spark.read.schema("term long, df long, bucket int").parquet(f"{path}/terms").filter(F.col("bucket").isin(inside))
            df = {r["term"]: r["df"] for r in known.join(F.broadcast(some), "term", "left_semi").collect()}
            side = spark.sparkContext.broadcast(_term_side(block, df, totals["docs"]))
            rows = index_postings(spark, path, wanted).select("doc", "doc_id", "term", "tf", "length")
            together = rows.repartition("doc").sortWithinPartitions("doc")
            avgdl = (totals["tokens"] or 0) / max(totals["texts"], 1)
            yield together.mapInArrow(_posting_scan(side, k, avgdl), schema)

    return _ranked(queries, answered(spark, n_blocks, hits(), schema), k, qid)


# --------------------------------------------------------------- vectors ---
def label_centroids(vectors: DataFrame, label: str = "label", vec: str = "embedding") -> DataFrame:
    """Mean vector per label as (qid, vector).

    One hash aggregate with one average per position (partial aggregation
    map side, no explode). All vectors must have one dimension.
    """
    sizes = vectors.filter(F.col(vec).isNotNull()).agg(F.min(F.size(vec)), F.max(F.size(vec))).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors of {sizes[0]} to {sizes[1]} dimensions have no common centroid")
    dim = int(sizes[0] or 0)
    means = [F.avg(F.get(vec, F.lit(i))).alias(f"__c{i}") for i in range(dim)]
    return vectors.groupBy(F.col(label).alias("qid")).agg(F.count(F.lit(1)).alias("__n"), *means).select(
        "qid", F.array(*[F.col(f"__c{i}") for i in range(dim)]).cast("array<double>").alias("vector")
    )


def vector_side(block):
    """Ids and matrix of a block of query vectors, in the order of the ids."""
    import numpy as np

    block = block.sort_values("qid", kind="stable")
    return block["qid"].to_numpy(), np.stack([np.asarray(x, dtype="float64") for x in block["vector"]])


def matrix_of(column):
    """An Arrow list column of vectors of one dimension as a matrix (single
    precision, as stored)."""
    import numpy as np

    flat = np.asarray(column.flatten()).astype("float32")
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def cosines(v32, qmat):
    """Cosines of vectors with query vectors, NaN where one is all zero."""
    import numpy as np

    # squares in single precision, sums in double (as SQL over float arrays)
    vn = np.sqrt((v32 * v32).astype("float64").sum(axis=1))
    qn = np.sqrt((qmat * qmat).sum(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        dots = v32.astype("float64") @ qmat.T
        sims = np.where((vn[:, None] > 0) & (qn[None, :] > 0), dots / (vn[:, None] * qn[None, :]), np.nan)
    return np.round(sims, 9)


def _cosine_scan(side, k: int, vec: str):
    """Cosines of batches of vectors against one block of query vectors."""

    def scan(batches):
        qids, qmat = side.value
        best, batch = Best(qids, k), None
        step = max(1, _CELLS // max(1, len(qids), qmat.shape[1]))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids, sims = ids_of(part.column("vec_id")), cosines(matrix_of(part.column(vec)), qmat)
                for j in range(len(qids)):
                    best.add(j, ids, sims[:, j])
        out = best.batch("vec_id", batch.column("vec_id").type) if batch is not None else None
        if out is not None:
            yield out

    return scan


def ranked_vectors(queries: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    best = top_k(hits, ["qid"], [F.col("score").desc_nulls_last(), F.col("vec_id").asc()], k)
    return queries.select("qid").join(best, "qid", "left").select(
        "qid", "rank", "vec_id", "score",
        F.when(F.col("vec_id").isNull(), F.lit(NOT_FOUND_MESSAGE)).alias("message"),
    )


def vector_blocks(queries: DataFrame, vectors: DataFrame, vec: str):
    """Blocks of query vectors (of the dimension of the vectors) of bounded size."""
    some = vectors.select(F.size(vec).alias("d")).first()
    queries = queries.filter("qid IS NOT NULL")  # they are answered with the message
    return query_blocks(queries, max(1, QUERY_BYTES // (8 * max(1, int(some["d"]) if some else 1))))


def kb_search_vec(
    queries: DataFrame, vectors: DataFrame, k: int = 5, vec_id: str = "vec_id", vec: str = "embedding"
) -> DataFrame:
    """Top-``k`` vectors per query vector by cosine similarity.

    ``queries`` holds (qid, vector). Query vectors are broadcast in blocks of
    bounded size, one scan of the vectors each; a scan scores Arrow batches
    with one matrix product and keeps a running top ``k`` per query, so only
    ``k`` rows per query and partition are shuffled. The plain form beside
    ``vectorcells.search_cells``, which reads the cells that matter.
    """
    spark = vectors.sparkSession
    queries = queries.select("qid", "vector")
    # a vector without values cannot be scored (as in SQL over its elements)
    v = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vec).alias(vec)).filter(F.col(vec).isNotNull())
    schema = f"qid {dict(queries.dtypes)['qid']}, vec_id {dict(v.dtypes)['vec_id']}, score double"
    n_blocks, blocks = vector_blocks(queries, v, vec)
    hits = (
        v.mapInArrow(_cosine_scan(spark.sparkContext.broadcast(vector_side(block)), k, vec), schema) for block in blocks
    )
    return ranked_vectors(queries, answered(spark, n_blocks, hits, schema), k)
