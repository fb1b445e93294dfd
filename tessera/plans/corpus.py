"""Queries over documents: order, splits, batches, words, encoding, budget."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixed_values import ACCUMULATION_STEPS, BATCH_SIZE, MAX_SEQ_LEN, VAL_EXAMPLES, VOCAB_SIZE
from tessera.functions.bytes import byte_token_count, special_count
from tessera.functions.sequences import ids_digest
from tessera.operators import ordering
from tessera.operators.budget import corpus_report
from tessera.operators.encoding import decode_ids, encode_ids
from tessera.operators.examples import pretraining_counts, pretraining_examples
from tessera.operators.vocabulary import (
    Vocabulary,
    load_or_train,
    pair_counts,
    train_vocabulary,
    word_counts,
    word_symbols,
)
from tessera.plans.sql import byte_ids, fitted, seeded
from tessera.plans.tables import table
from tessera.session import scratch_path
from tessera.sources.corpora import CORPORA, CorpusSpec, load_corpus, read_split, rename_text
from tessera.streaming.incremental import encode_stream, read_new_files

HOLDOUT = 100
SAMPLE = 500
NATIVE_VAL = 25
EPOCHS = 2
# Files of the encoding stream: written per wave by so many documents each, and read in so many batches.
STREAM_FILE_DOCS = 2_000
STREAM_BATCHES = 2
MERGES = 24
FEW_MERGES = 8


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents for work that is heavy per row."""
    return _documents(spark, folder).select("doc_id", "text")


def shuffle_order(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.with_positions(_documents(spark, folder).select("doc_id"), "doc_id")


def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.with_split(_documents(spark, folder), "doc_id", HOLDOUT).select("doc_id", "split")


def native_val(spark: SparkSession, folder: str) -> DataFrame:
    spec = CorpusSpec("benchmark", None, "train", text_column="Text", val_split="test")
    source = table(spark, folder, "benchmark").withColumnRenamed("text", "Text")
    return ordering.native_val(rename_text(source, spec), "item_id", NATIVE_VAL).select("item_id", "text")


def tokenizer_sample(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.tokenizer_sample(_documents(spark, folder), "doc_id", HOLDOUT, SAMPLE).select("doc_id")


def split_leakage(spark: SparkSession, folder: str) -> DataFrame:
    train, val = ordering.holdout_split(_documents(spark, folder), "doc_id", HOLDOUT)
    return ordering.split_leakage(train, val).select("doc_id")


def batches(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.with_batches(_documents(spark, folder).select("doc_id"), "doc_id")


def step_plan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id")
    n_batches = docs.count() // BATCH_SIZE
    steps = -(-EPOCHS * n_batches // ACCUMULATION_STEPS)
    plan = ordering.step_plan(spark, n_batches, steps)
    return ordering.training_manifest(ordering.with_batches(docs, "doc_id"), plan)


def _one_space(docs: DataFrame, *keep: str) -> DataFrame:
    """White-space runs as one space, because the oracle's patterns cannot look ahead."""
    return docs.select(*keep, F.regexp_replace("text", "[ \\t\\n\\r]+", " ").alias("text"))


def words(spark: SparkSession, folder: str) -> DataFrame:
    return word_counts(_one_space(_texts(spark, folder)))


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return pair_counts(word_symbols(words(spark, folder)))


def _small_vocabulary(spark: SparkSession, folder: str, merges: int) -> Vocabulary:
    return train_vocabulary(words(spark, folder), Vocabulary().size + merges)


def bpe_merges(spark: SparkSession, folder: str) -> DataFrame:
    return _small_vocabulary(spark, folder, MERGES).merges_frame(spark)


def encoded_docs(spark: SparkSession, folder: str) -> DataFrame:
    coded = pretraining_examples(_texts(spark, folder))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.greatest(MAX_SEQ_LEN - F.col("n_tokens"), F.lit(0)).alias("n_pad"),
        (F.col("n_tokens") > MAX_SEQ_LEN).alias("truncated"),
        ids_digest(F.col("input_ids")).alias("ids_md5"),
        ids_digest(F.col("labels")).alias("labels_md5"),
    )


def merged_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents (white space as in ``words``) encoded with trained merges."""
    vocab = _small_vocabulary(spark, folder, FEW_MERGES)
    docs = _one_space(_documents(spark, folder), "doc_id")
    coded = docs.withColumn("ids", encode_ids(F.col("text"), vocab, spark))
    return coded.select("doc_id", F.size("ids").alias("n_tokens"), ids_digest(F.col("ids")).alias("ids_md5"))


def corpus_encoded(spark: SparkSession, folder: str) -> DataFrame:
    """A named corpus from its files to examples: load, hold out, sample, train, save, load, encode."""
    spec = replace(CORPORA["fineweb_edu"], val_holdout_examples=HOLDOUT)
    root, saved = scratch_path(spark, "corpora"), scratch_path(spark, "vocabulary")
    _one_space(_documents(spark, folder), "doc_id").write.parquet(spec.location(root, spec.split))
    train, val = load_corpus(spark, spec, root, "doc_id", shuffled=False)
    sample = ordering.tokenizer_sample(read_split(spark, spec, root, spec.split), "doc_id", HOLDOUT, SAMPLE)
    size = Vocabulary().size + FEW_MERGES
    load_or_train(sample, saved, vocab_size=size)
    vocab = load_or_train(sample, saved, vocab_size=size)
    both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    coded = pretraining_examples(both, vocab)
    return coded.select("doc_id", "split", "n_tokens", ids_digest(F.col("input_ids")).alias("ids_md5"))


def decoded_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Texts encoded with merges and decoded again: whole, with their special tokens kept, and cut
    inside the character at their end."""
    vocab = _small_vocabulary(spark, folder, FEW_MERGES)
    marked = F.concat(F.col("text"), F.lit("[PAD]é"))
    coded = _texts(spark, folder).withColumn("ids", encode_ids(marked, vocab, spark))
    cut = F.slice("ids", 1, F.size("ids") - 1)
    return coded.select(
        "doc_id",
        F.md5(decode_ids(F.col("ids"), vocab, spark)).alias("text_md5"),
        F.md5(decode_ids(F.col("ids"), vocab, spark, skip_special_tokens=False)).alias("marked_md5"),
        F.md5(decode_ids(cut, vocab, spark)).alias("cut_md5"),
    )


def literal_specials(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that carry a special token literally; every 50th is given one."""
    docs = _documents(spark, folder).withColumn(
        "text",
        F.when(F.col("doc_id") % 50 == 0, F.concat(F.col("text"), F.lit("[PAD]x[UNK]"))).otherwise(
            F.col("text")
        ),
    )
    found = docs.select(
        "doc_id",
        special_count(F.col("text")).alias("n_specials"),
        byte_token_count(F.col("text")).alias("n_tokens"),
        ids_digest(encode_ids(F.col("text"), Vocabulary(), spark)).alias("ids_md5"),
    )
    return found.where(F.col("n_specials") > 0)


def report(spark: SparkSession, folder: str) -> DataFrame:
    docs = ordering.with_split(_documents(spark, folder), "doc_id", HOLDOUT)
    return corpus_report(pretraining_counts(docs), ["split", "source"], batch_size=4, accumulation=2)


def native_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """A named corpus with a validation split of its own, both renamed, the training rows shuffled: tokens and targets."""
    spec, root = CORPORA["tiny_shakespeare"], scratch_path(spark, "corpora")
    for split, name, key in ((spec.split, "documents", "doc_id"), (spec.val_split, "benchmark", "item_id")):
        rows = table(spark, folder, name).select(F.col(key).alias("id"), F.col("text").alias(spec.text_column))
        rows.write.parquet(spec.location(root, split))
    train, val = load_corpus(spark, spec, root, "id", val_examples=VAL_EXAMPLES)
    both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    return pretraining_counts(both).select("id", "split", "n_tokens", "n_targets")


def reference_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """The merges of a vocabulary of the full size, from all documents."""
    return train_vocabulary(word_counts(_texts(spark, folder)), VOCAB_SIZE).merges_frame(spark)


def stream_equals_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in several files, encoded file by file by a stream that is stopped and started
    again, against one batch job."""
    docs = _documents(spark, folder).select("doc_id", "text")
    base = scratch_path(spark, "encode-stream")
    even = F.col("doc_id") % 2 == 0
    for wave in (even, ~even):
        files = max(4, -(-docs.where(wave).count() // STREAM_FILE_DOCS))
        docs.where(wave).repartition(files, "doc_id").write.mode("append").parquet(f"{base}/in")
        stream = read_new_files(spark, f"{base}/in", docs.schema, files_per_batch=-(-files // STREAM_BATCHES))
        encode_stream(stream, f"{base}/out", f"{base}/progress").awaitTermination()
    streamed = spark.read.parquet(f"{base}/out").select("doc_id", ids_digest(F.col("input_ids")).alias("s"))
    batch = pretraining_examples(docs).select("doc_id", ids_digest(F.col("input_ids")).alias("b"))
    return batch.join(streamed, "doc_id", "full").select("doc_id", F.col("b").alias("batch_md5"), F.col("s").alias("stream_md5"))


_POSITIONS = f"""SELECT doc_id, text, source, row_number() OVER (ORDER BY {seeded('doc_id')}, doc_id) - 1 AS pos
    FROM documents"""
# The word pattern without look-ahead, for texts whose white space is single spaces.
_WORD_SQL = r"''(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
_WORDS = rf"""
    words AS (
        SELECT unnest(regexp_extract_all(regexp_replace(text, '[ \t\n\r]+', ' ', 'g'), '{_WORD_SQL}')) AS word
        FROM documents
    ),
    word_counts AS (SELECT word, count(*) AS n FROM words GROUP BY word)
"""



# The same table with counts from the tokenizer sample alone; words outside it count nothing.
_SAMPLED = rf"""
    words AS (
        SELECT unnest(regexp_extract_all(regexp_replace(text, '[ \t\n\r]+', ' ', 'g'), '{_WORD_SQL}')) AS word,
            (pos >= {HOLDOUT} AND pos < {HOLDOUT + SAMPLE})::INT AS own
        FROM ({_POSITIONS})
    ),
    word_counts AS (SELECT word, sum(own)::BIGINT AS n FROM words GROUP BY word)
"""
_SPLIT_DOCS = rf"""
    split AS (
        SELECT doc_id, regexp_extract_all(regexp_replace(text, '[ \t\n\r]+', ' ', 'g'), '{_WORD_SQL}') AS words
        FROM documents
    ),
    placed AS (SELECT doc_id, i, words[i] AS word FROM split, unnest(range(1, len(words) + 1)) AS u(i))
"""


def _merging(merges: int, words: str = _WORDS) -> str:
    """WITH RECURSIVE entries: the word table after every single merge. Each symbol stands between
    two spaces, so replacing a pair's text never touches another symbol."""
    return f"""{words},
    merging AS (
        SELECT 0 AS step, word, ' ' || array_to_string({byte_ids('word')}, '  ') || ' ' AS sym, n,
            NULL::INT AS l, NULL::INT AS r FROM word_counts
        UNION ALL
        SELECT m.step + 1, word, replace(m.sym, ' ' || b.l || '  ' || b.r || ' ', ' ' || (258 + m.step) || ' '),
            m.n, b.l, b.r
        FROM merging m, (
            SELECT p[1] AS l, p[2] AS r FROM (
                SELECT unnest(list_zip(ids[1:len(ids) - 1], ids[2:])) AS p, n FROM (
                    SELECT string_split(trim(sym), '  ')::INT[] AS ids, n FROM merging
                ) WHERE len(ids) > 1
            ) GROUP BY 1, 2 ORDER BY sum(n) DESC, 1, 2 LIMIT 1
        ) b WHERE m.step < {merges}
    )"""


QUERIES = {
    "shuffle_order": (shuffle_order, f"SELECT doc_id, pos FROM ({_POSITIONS})"),
    "holdout_split": (
        holdout_split,
        f"SELECT doc_id, CASE WHEN pos < {HOLDOUT} THEN 'val' ELSE 'train' END AS split FROM ({_POSITIONS})",
    ),
    "native_val": (native_val, f"SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT {NATIVE_VAL}"),
    "tokenizer_sample": (
        tokenizer_sample,
        f"SELECT doc_id FROM ({_POSITIONS}) WHERE pos >= {HOLDOUT} AND pos < {HOLDOUT + SAMPLE}",
    ),
    "split_leakage": (
        split_leakage,
        f"""WITH p AS ({_POSITIONS})
        SELECT doc_id FROM p WHERE pos >= {HOLDOUT} AND text IN (SELECT text FROM p WHERE pos < {HOLDOUT})""",
    ),
    "batches": (
        batches,
        f"""SELECT doc_id, pos // {BATCH_SIZE} AS batch_no, pos % {BATCH_SIZE} AS slot FROM ({_POSITIONS})
        WHERE pos // {BATCH_SIZE} < (SELECT count(*) FROM documents) // {BATCH_SIZE}""",
    ),
    "step_plan": (
        step_plan,
        f"""WITH p AS ({_POSITIONS}), n AS (SELECT count(*) // {BATCH_SIZE} AS n FROM documents),
        micros AS (
            SELECT i, n FROM n, unnest(range(CAST(ceil({EPOCHS} * n / {ACCUMULATION_STEPS}) AS BIGINT) * {ACCUMULATION_STEPS})) AS u(i)
        )
        SELECT i // {ACCUMULATION_STEPS} AS step, i % {ACCUMULATION_STEPS} AS micro, i // n AS epoch,
            i % n AS batch_no, doc_id, pos % {BATCH_SIZE} AS slot
        FROM micros JOIN p ON p.pos // {BATCH_SIZE} = i % n""",
    ),
    "word_counts": (words, f"WITH {_WORDS} SELECT word, n FROM word_counts"),
    "pair_counts": (
        pairs,
        f"""WITH {_WORDS}, coded AS (SELECT {byte_ids('word')} AS ids, n FROM word_counts),
        pairs AS (SELECT unnest(list_zip(ids[1:len(ids) - 1], ids[2:])) AS p, n FROM coded WHERE len(ids) > 1)
        SELECT p[1] AS left_id, p[2] AS right_id, sum(n)::BIGINT AS n FROM pairs GROUP BY ALL""",
    ),
    "bpe_merges": (
        bpe_merges,
        f"""WITH RECURSIVE {_merging(MERGES)}
        SELECT step - 1 AS rank, any_value(l) AS left_id, any_value(r) AS right_id, 257 + step AS new_id
        FROM merging WHERE step > 0 GROUP BY step""",
    ),
    "merged_docs": (
        merged_docs,
        rf"""WITH RECURSIVE {_merging(FEW_MERGES)},
        coded AS (SELECT word, string_split(trim(sym), '  ') AS ids FROM merging WHERE step = {FEW_MERGES}),
        {_SPLIT_DOCS},
        joined AS (SELECT doc_id, flatten(list(ids ORDER BY i)) AS ids FROM placed JOIN coded USING (word) GROUP BY doc_id)
        SELECT doc_id, len(ids) AS n_tokens, md5(array_to_string(ids, ',')) AS ids_md5 FROM joined""",
    ),
    "corpus_encoded": (
        corpus_encoded,
        rf"""WITH RECURSIVE {_merging(FEW_MERGES, _SAMPLED)},
        coded AS (SELECT word, string_split(trim(sym), '  ')::INT[] AS ids FROM merging WHERE step = {FEW_MERGES}),
        {_SPLIT_DOCS},
        joined AS (SELECT doc_id, flatten(list(ids ORDER BY i)) AS ids FROM placed JOIN coded USING (word) GROUP BY doc_id)
        SELECT doc_id, CASE WHEN pos < {HOLDOUT} THEN 'val' ELSE 'train' END AS split, len(ids) AS n_tokens,
            md5(array_to_string({fitted('ids', MAX_SEQ_LEN, 1)}, ',')) AS ids_md5
        FROM joined JOIN ({_POSITIONS}) USING (doc_id)""",
    ),
    "encoded_docs": (
        encoded_docs,
        f"""WITH c AS (SELECT doc_id, {byte_ids('text')} AS ids FROM documents),
        f AS (SELECT doc_id, len(ids) AS n_tokens, {fitted('ids', MAX_SEQ_LEN, 1)} AS input_ids FROM c)
        SELECT doc_id, n_tokens, greatest({MAX_SEQ_LEN} - n_tokens, 0) AS n_pad,
            n_tokens > {MAX_SEQ_LEN} AS truncated, md5(array_to_string(input_ids, ',')) AS ids_md5,
            md5(array_to_string(list_transform(input_ids, lambda i: CASE WHEN i = 1 THEN -100 ELSE i END), ',')) AS labels_md5
        FROM f""",
    ),
    "decoded_docs": (
        decoded_docs,
        """SELECT doc_id, md5(text || 'é') AS text_md5, md5(text || '[PAD]é') AS marked_md5,
            md5(text || chr(65533)) AS cut_md5 FROM documents""",
    ),
    "literal_specials": (
        literal_specials,
        f"""SELECT doc_id, 2 AS n_specials, octet_length(encode(text)) + 3 AS n_tokens,
            md5(array_to_string(list_concat({byte_ids('text')}, [1], {byte_ids("'x'")}, [0]), ',')) AS ids_md5
        FROM documents WHERE doc_id % 50 = 0""",
    ),
    "corpus_report": (
        report,
        f"""WITH p AS ({_POSITIONS}),
        t AS (SELECT CASE WHEN pos < {HOLDOUT} THEN 'val' ELSE 'train' END AS split, source,
            octet_length(encode(text)) AS n, least(octet_length(encode(text)), {MAX_SEQ_LEN}) AS k FROM p)
        SELECT split, source, count(*) AS n_docs, sum(n)::BIGINT AS raw_tokens, sum(k)::BIGINT AS kept_tokens,
            sum({MAX_SEQ_LEN} - k)::BIGINT AS pad_tokens, sum(greatest(k - 1, 0))::BIGINT AS targets,
            count(*) FILTER (WHERE n > {MAX_SEQ_LEN}) AS truncated, count(*) // 4 AS n_batches,
            count(*) // 8 AS n_steps, (count(*) // 8) * {4 * 2 * MAX_SEQ_LEN} AS step_tokens
        FROM t GROUP BY split, source""",
    ),
    "native_corpus": (
        native_corpus,
        f"""WITH d AS (SELECT doc_id AS id, 'train' AS split, text FROM documents
            UNION ALL (SELECT item_id, 'val', text FROM benchmark ORDER BY item_id LIMIT {VAL_EXAMPLES})),
        n AS (SELECT id, split, octet_length(encode(text)) AS n FROM d)
        SELECT id, split, n::INT AS n_tokens, greatest(least(n, {MAX_SEQ_LEN}) - 1, 0)::INT AS n_targets FROM n""",
    ),
    # No SQL: recursive SQL takes one merge at a time over the whole word table.
    "reference_vocabulary": (reference_vocabulary, None),
    "stream_equals_batch": (
        stream_equals_batch,
        f"""WITH c AS (SELECT doc_id, {byte_ids('text')} AS ids FROM documents),
        f AS (SELECT doc_id, md5(array_to_string({fitted('ids', MAX_SEQ_LEN, 1)}, ',')) AS m FROM c)
        SELECT doc_id, m AS batch_md5, m AS stream_md5 FROM f""",
    ),
}
