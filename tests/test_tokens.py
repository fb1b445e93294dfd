import random

import pytest
from pyspark.sql import functions as F

from tessera.fixed_values import IGNORE_INDEX, PAD_ID
from tessera.functions.bytes import byte_order, byte_token_count, byte_tokens
from tessera.functions.sequences import fit_length, labels_for, next_token_targets, target_count
from tessera.functions.words import is_blank, split_pieces, split_words
from tessera.operators.encoding import decode_ids, encode_ids, token_counts
from tessera.operators.examples import pretraining_counts, pretraining_examples
from tessera.operators.vocabulary import (
    Vocabulary,
    load_or_train,
    load_vocabulary,
    save_vocabulary,
    train_vocabulary,
    word_counts,
    word_symbols,
)
from tessera.plans import chat as chat_plans
from tessera.plans import corpus as corpus_plans
from tessera.plans import runs as runs_plans

TEXTS = [
    "hello world",
    "",
    "日本語 emoji 🎉 café",
    "tabs\tand  double  spaces \n\n new\r\nlines   ",
    "it's we'll they've I'M don't 12345 6.5% === ---- [x]",
    "a b c　d",
    "[PAD] in the [UNK]middle[PAD][PAD]",
    "[[PAD]] x.[PAD]  [PAD]y",
    "x" * 3000 + "=" * 5000 + "ab" * 2000,
]


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    return [
        " ".join(rng.choice(stems) + rng.choice(["", "s", "ing", "ab"]) for _ in range(rng.randint(1, 40)))
        for _ in range(n)
    ]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def public_tokenizer(texts, size):
    tokenizers = pytest.importorskip("tokenizers")
    from tokenizers import decoders, models, pre_tokenizers, trainers

    tok = tokenizers.Tokenizer(models.BPE(unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = decoders.ByteLevel()
    tok.train_from_iterator(
        texts,
        trainer=trainers.BpeTrainer(
            vocab_size=size, special_tokens=["[UNK]", "[PAD]"],
            initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), show_progress=False,
        ),
    )
    return tok


@pytest.fixture(scope="module")
def trained(spark):
    texts = corpus()
    return texts, train_vocabulary(word_counts(frame(spark, texts)), 600)


def test_words_are_lossless(spark):
    rows = frame(spark, TEXTS).select("text", F.array_join(split_words(F.col("text")), "").alias("again"),
                                      F.array_join(split_pieces(F.col("text")), "").alias("pieces")).collect()
    assert all(r["text"] == r["again"] == r["pieces"] for r in rows)


def test_byte_tokens(spark):
    ids = {b: i + 2 for i, b in enumerate(byte_order())}
    plain = [t for t in TEXTS if "[PAD]" not in t]
    rows = frame(spark, plain).select("text", byte_tokens(F.col("text")).alias("ids"),
                                      byte_token_count(F.col("text")).alias("n")).collect()
    for r in rows:
        assert r["ids"] == [ids[b] for b in r["text"].encode()] and r["n"] == len(r["ids"])


def test_literal_specials_are_single_ids(spark):
    rows = frame(spark, ["hello world", "hello world[PAD]", "[UNK]"]).select(
        byte_tokens(F.col("text")).alias("ids")).collect()
    assert rows[1]["ids"] == rows[0]["ids"] + [PAD_ID]
    assert rows[2]["ids"] == [0]


def test_vocabulary_equals_public_trainer(trained):
    import json

    texts, vocab = trained
    model = json.loads(public_tokenizer(texts, 600).to_str())["model"]
    ids = model["vocab"]
    merges = [(ids[a], ids[b], ids[a + b]) for a, b in model["merges"]]
    assert list(vocab.merges) == merges
    assert vocab.size == len(ids)


def test_few_candidates_give_the_same_merges(spark, trained):
    texts, vocab = trained
    one_by_one = train_vocabulary(word_counts(frame(spark, texts)), 300, candidates=2)
    assert one_by_one.merges == vocab.merges[: len(one_by_one.merges)] and one_by_one.size == 300


def test_thousands_of_merges_equal_the_public_trainer(spark):
    """More merges than candidates, so pairs are counted again; several shards; repeated texts of symbols."""
    import json

    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(30)) for _ in range(150)]
    size = 258 + 4096
    model = json.loads(public_tokenizer(texts, size).to_str())["model"]
    ids = model["vocab"]
    merges = [(ids[a], ids[b], ids[a + b]) for a, b in model["merges"]]
    vocab = train_vocabulary(word_counts(frame(spark, texts)), size, candidates=3000)
    assert len(merges) == 4096 and list(vocab.merges) == merges


def test_a_half_saved_vocabulary_is_not_loaded(spark, trained, tmp_path):
    _, vocab = trained
    path = f"{tmp_path}/half"
    vocab.merges_frame(spark).write.parquet(f"{path}/version-x/merges")
    assert load_vocabulary(spark, path) is None
    save_vocabulary(spark, Vocabulary(), path)
    save_vocabulary(spark, vocab, path)
    again = load_vocabulary(spark, path)
    assert again.merges == vocab.merges and again.symbols == vocab.symbols


def test_encoding_equals_public_encoder(spark, trained):
    texts, vocab = trained
    tok = public_tokenizer(texts, 600)
    rows = (
        frame(spark, TEXTS + texts[:50])
        .withColumn("ids", encode_ids(F.col("text"), vocab, spark))
        .withColumn("plain", decode_ids(F.col("ids"), vocab, spark))
        .withColumn("full", decode_ids(F.col("ids"), vocab, spark, skip_special_tokens=False))
        .collect()
    )
    for r in rows:
        assert r["ids"] == tok.encode(r["text"]).ids
        assert r["full"] == r["text"]
        assert r["plain"] == tok.decode(r["ids"])


def test_cut_character_decodes_to_replacement(spark):
    vocab = Vocabulary()
    big = Vocabulary(((0, 0, 258),), vocab.symbols + [b"?"] * 600)
    for v in (vocab, big):  # the native and the Arrow decoder
        row = frame(spark, ["café"]).withColumn("ids", byte_tokens(F.col("text"))).select(
            decode_ids(F.slice("ids", 1, 4), v, spark).alias("cut"), decode_ids(F.col("ids"), v, spark).alias("all")
        ).first()
        assert row["cut"] == "caf�" and row["all"] == "café"


def test_null_texts_stay_null(spark, trained):
    _, vocab = trained
    rows = frame(spark, ["ab", None, "cd"]).withColumn("ids", encode_ids(F.col("text"), vocab, spark)).withColumn(
        "back", decode_ids(F.col("ids"), vocab, spark)).orderBy("id").collect()
    assert [r["back"] for r in rows] == ["ab", None, "cd"] and rows[1]["ids"] is None


def test_token_counts_of_text_arrays(spark, trained):
    texts, vocab = trained
    df = spark.createDataFrame([(["ab cd", "", "x[PAD]"],), (None,), ([],)], "t array<string>")
    for v in (vocab, Vocabulary()):
        rows = df.select(token_counts(F.col("t"), v, spark).alias("n")).collect()
        lengths = frame(spark, ["ab cd", "", "x[PAD]"]).select(F.size(encode_ids(F.col("text"), v, spark)).alias("n"), "id").orderBy("id").collect()
        assert rows[0]["n"] == [r["n"] for r in lengths] and rows[1]["n"] is None and rows[2]["n"] == []


def test_small_size_keeps_the_byte_alphabet(spark):
    assert train_vocabulary(word_counts(frame(spark, ["hello"])), 50).size == 258


def test_saved_vocabulary_is_loaded_not_trained(spark, tmp_path):
    path = str(tmp_path / "vocab")
    assert load_vocabulary(spark, path) is None
    first = load_or_train(frame(spark, ["aa aa ab"] * 3), path, vocab_size=260)
    again = load_or_train(frame(spark, ["zz zz zz"] * 3), path, vocab_size=260)
    assert again == first and again.symbols == first.symbols and first.merges


def test_fit_length_and_labels(spark):
    row = spark.sql("SELECT array(5, 6, 7) AS ids").select(
        fit_length(F.col("ids"), 5).alias("long"), fit_length(F.col("ids"), 2).alias("short")).first()
    assert row["long"] == [5, 6, 7, PAD_ID, PAD_ID] and row["short"] == [5, 6]


def test_pretraining_labels_mask_padding(spark):
    rows = pretraining_examples(frame(spark, ["hi", "hello"]), max_seq_len=5).collect()
    for r in rows:
        assert len(r["input_ids"]) == len(r["labels"]) == 5
        assert [lab == IGNORE_INDEX for lab in r["labels"]] == [i == PAD_ID for i in r["input_ids"]]


def test_next_token_targets(spark):
    row = spark.sql("SELECT array(3, 4, 5) AS ids, array(3, -100, 5) AS labels").select(
        next_token_targets(F.col("ids"), F.col("labels")).alias("t"), target_count(F.col("labels")).alias("n")
    ).first()
    assert [tuple(x) for x in row["t"]] == [(3, -100), (4, 5)] and row["n"] == 1


def test_blank_matches_python_strip(spark):
    texts = ["", " ", "\n\t", " 　", "\x1c\x1f", "\x85", "a", " . ", "​"]
    rows = frame(spark, texts).withColumn("blank", is_blank(F.col("text"))).collect()
    assert all(r["blank"] == (not r["text"].strip()) for r in rows)


def test_labels_for(spark):
    row = spark.sql("SELECT array(7, 1, 8) AS ids").select(labels_for(F.col("ids")).alias("l")).first()
    assert row["l"] == [7, IGNORE_INDEX, 8]


def test_no_symbols_are_made_below_the_word_count(spark):
    """Words are counted as text; only the distinct ones become symbols."""
    words = word_counts(spark.createDataFrame([(1, "a b a cc dd")], "id int, text string"))
    plan = word_symbols(words.where(F.octet_length("word") > 1))._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate") :].partition("\n")[2]
    assert "translate" in plan and "translate" not in below


def test_chat_batches_encode_once(spark):
    plan = chat_plans.chat_batches(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1


def test_leakage_plans_are_plain_filters(spark):
    plan = corpus_plans.split_leakage(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "hashpartitioning(_bucket" not in plan


def test_flat_tail_reads_the_log_twice(spark):
    plan = runs_plans.flat_tail(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # Once for the bounds, which are written; then once for the hot and once for the other runs.
    assert plan.count("event_type") > 0 and plan.count("Aggregate [run") == 1


def test_ids_outside_the_vocabulary_decode_to_nothing(spark):
    ids = spark.createDataFrame([([66, 9999, -4, None, 67],)], "ids array<int>")
    for vocab in (Vocabulary(), train_vocabulary(word_counts(frame(spark, ["aa ab"])), 260)):
        row = ids.select(decode_ids(F.col("ids"), vocab, spark).alias("t")).first()
        assert row["t"] == (vocab.symbols[66] + vocab.symbols[67]).decode()


def test_counts_equal_those_of_the_examples(spark, trained):
    """Targets counted without building examples, with literal padding tokens and cuts."""
    _, vocab = trained
    texts = frame(spark, [*TEXTS, "[PAD]", "a[PAD]", "[PAD][PAD]b" * 9, "plain words " * 9])
    for v in (None, vocab):
        for length in (8, 40):
            built = pretraining_examples(texts, v, length).select("id", "n_tokens", target_count(F.col("labels")).alias("n_targets"))
            counted = pretraining_counts(texts, v, length).select("id", "n_tokens", "n_targets")
            assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, built.collect()))
