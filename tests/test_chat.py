import itertools
import json

import duckdb
import pytest
from compare import differences
from pyspark.sql import functions as F

from tessera.fixed_values import IGNORE_INDEX, JUDGE_TEMPLATE, PAD_ID
from tessera.functions.bytes import byte_order, byte_token_count
from tessera.functions.chat import build_prompt, format_history, format_prompt, format_turn, judge_request
from tessera.operators.conversations import (
    MESSAGES_TYPE,
    assemble,
    chat_prompts,
    fit_context,
    flatten_messages,
    messages_error,
    validate_conversations,
)
from tessera.operators.examples import chat_examples, preference_examples, preference_prompts
from tessera.operators.requests import request_outcomes
from tessera.operators.replies import assemble_replies
from tessera.operators.vocabulary import train_vocabulary, word_counts
from tessera.plans.chat import QUERIES as chat_queries

IDS = {b: i + 2 for i, b in enumerate(byte_order())}


def turns(spark, conversations):
    rows = [(c, t, role, text) for c, messages in conversations.items() for t, (role, text) in enumerate(messages)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def encoded(role, content):
    return [IDS[b] for b in f"<|{role}|>\n{content}\n".encode()]


def cut_or_filled(values, length, filler):
    return (values + [filler] * length)[:length]


def test_markup(spark):
    row = spark.sql("SELECT array(named_struct('role','user','content','a'), named_struct('role','assistant','content','b'), named_struct('role','user','content','c')) AS m").select(
        format_turn(F.lit("user"), F.lit("hi")).alias("turn"),
        format_prompt(F.lit("hi")).alias("prompt"),
        format_history(F.col("m")).alias("history"),
        format_history(F.slice("m", 1, 1)).alias("one"),
        format_prompt(F.lit("a")).alias("one_prompt"),
        build_prompt(F.lit("x"), False).alias("raw"),
        build_prompt(F.lit("x"), True).alias("chat"),
    ).first()
    assert row["turn"] == "<|user|>\nhi\n"
    assert row["prompt"] == "<|user|>\nhi\n<|assistant|>\n"
    assert row["history"] == "<|user|>\na\n<|assistant|>\nb\n<|user|>\nc\n<|assistant|>\n"
    assert row["one"] == row["one_prompt"]
    assert row["raw"] == "x" and row["chat"] == "<|user|>\nx\n<|assistant|>\n"


def test_judge_request_fills_the_template(spark):
    got = spark.range(1).select(judge_request(F.lit("50% {x}"), F.lit("{prompt}"), F.lit("b"))).first()[0]
    assert got == JUDGE_TEMPLATE.format(prompt="50% {x}", response_a="{prompt}", response_b="b")


CONVERSATIONS = {
    1: [("system", "answer in rhyme"), ("user", "name a bird"), ("assistant", "wren")],
    2: [("user", "two?"), ("assistant", "three"), ("user", "four?"), ("assistant", "five")],
    3: [("user", "日本 🎉"), ("user", "")],
    4: [("assistant", "x" * 500)],
    5: [("user", "q"), ("assistant", "a")] * 40,
}
# The text of every example, each stop token shown as "#", and its supervised stretches.
SPELLED = {
    1: ("<|system|>\nanswer in rhyme\n<|user|>\nname a bird\n<|assistant|>\nwren\n#", ["<|assistant|>\nwren\n#"]),
    2: ("<|user|>\ntwo?\n<|assistant|>\nthree\n#<|user|>\nfour?\n<|assistant|>\nfive\n#",
        ["<|assistant|>\nthree\n#", "<|assistant|>\nfive\n#"]),
    3: ("<|user|>\n日本 🎉\n<|user|>\n\n", []),
    4: ("<|assistant|>\n" + "x" * 500 + "\n#", ["<|assistant|>\n" + "x" * 500 + "\n#"]),
    5: ("<|user|>\nq\n<|assistant|>\na\n#" * 40, ["<|assistant|>\na\n#"] * 40),
}


def spelled_ids(text):
    return [PAD_ID if b == ord("#") else IDS[b] for b in text.encode()]


def spelled_labels(text, stretches):
    found, at = [IGNORE_INDEX] * len(text.encode()), 0
    for stretch in stretches:
        at = text.index(stretch, at)
        begin = len(text[:at].encode())
        found[begin : begin + len(stretch.encode())] = spelled_ids(stretch)
        at += len(stretch)
    return found


@pytest.mark.parametrize("length", [5, 64, 128, 300])
def test_chat_examples(spark, length):
    rows = chat_examples(turns(spark, CONVERSATIONS), max_seq_len=length).collect()
    assert len(rows) == len(CONVERSATIONS)
    for r in rows:
        text, stretches = SPELLED[r["conv_id"]]
        assert r["input_ids"] == cut_or_filled(spelled_ids(text), length, PAD_ID)
        assert r["labels"] == cut_or_filled(spelled_labels(text, stretches), length, IGNORE_INDEX)
        total = len(text.encode())
        assert r["kept_ids"] == min(total, length) and r["truncated"] == (total > length) and r["error"] is None


def test_chat_example_that_ends_at_the_limit(spark):
    first = len(SPELLED[2][0].split("#")[0].encode()) + 1
    one, two = CONVERSATIONS[2][:2], CONVERSATIONS[2]
    rows = {r["conv_id"]: r for r in chat_examples(turns(spark, {1: one, 2: two}), max_seq_len=first).collect()}
    assert (rows[1]["kept_ids"], rows[1]["truncated"]) == (first, False)
    assert (rows[2]["kept_ids"], rows[2]["truncated"]) == (first, True)


def test_chat_example_with_a_null_turn_has_a_reason(spark):
    broken = {1: [("user", "a"), ("assistant", None)], 2: [(None, "a")], 3: [("user", "a"), ("assistant", "b")]}
    rows = {r["conv_id"]: r for r in chat_examples(turns(spark, broken), max_seq_len=64).collect()}
    assert [rows[i]["error"] for i in (1, 2, 3)] == ["null_turn", "null_turn", None]
    assert rows[1]["input_ids"] is None and rows[2]["labels"] is None and rows[3]["input_ids"]


def test_chat_examples_with_merges_match_turn_by_turn_encoding(spark):
    df = turns(spark, CONVERSATIONS)
    vocab = train_vocabulary(word_counts(df), 280)
    merged = {r["conv_id"]: r for r in chat_examples(df, vocab, 96).collect()}
    plain = {r["conv_id"]: r for r in chat_examples(df, None, 96).collect()}
    def spell(ids):
        return b"".join(vocab.symbols[i] for i in ids if i > 1)

    one = merged[1]
    assert spell(one["input_ids"]).decode() == SPELLED[1][0].rstrip("#")
    assert spell(i for i in one["labels"] if i != IGNORE_INDEX).decode() == "<|assistant|>\nwren\n"
    assert one["kept_ids"] < plain[1]["kept_ids"]
    assert [len(r["input_ids"]) for r in merged.values()] == [96] * 5


def test_a_conversation_with_most_turns_stays_whole(spark):
    hot = spark.range(3000).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
    )
    df = hot.unionByName(turns(spark, {1: CONVERSATIONS[1]}))
    (row,) = chat_prompts(df).where("conv_id = 7").collect()
    whole = "".join(f"<|{'user' if i % 2 == 0 else 'assistant'}|>\nt{i}\n" for i in range(3000))
    assert row["prompt"] == whole + "<|assistant|>\n"
    row = validate_conversations(df).where("conv_id = 7").first()
    assert row["error"] == "messages has 3000 entries, exceeds limit of 50" and row["messages"] is None
    example = chat_examples(df, max_seq_len=256).where("conv_id = 7").first()
    text = "".join(f"<|user|>\nt{i}\n<|assistant|>\nt{i + 1}\n#" for i in range(0, 60, 2))
    answers = [f"<|assistant|>\nt{i}\n#" for i in range(1, 60, 2)]
    assert example["input_ids"] == spelled_ids(text)[:256] and example["labels"] == spelled_labels(text, answers)[:256]
    assert example["truncated"]


def test_assemble_and_back(spark):
    df = turns(spark, CONVERSATIONS)
    again = flatten_messages(assemble(df))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))
    lists = assemble(df).drop("turns")  # without their numbers, turns count from 0
    assert sorted(map(tuple, flatten_messages(lists).collect())) == sorted(map(tuple, df.collect()))


LONG = {
    1: [(t, "user" if t % 2 == 0 else "assistant") for t in range(120)],  # 119 turns up to the last question
    2: [(0, "system")] + [(t, "user" if t % 2 else "assistant") for t in range(1, 61)],
    3: [(t * 3 + 7, "user" if t % 2 == 0 else "assistant") for t in range(75)],
    4: [(t + 5, "user" if t % 2 == 0 else "assistant") for t in range(49)],
    5: [(0, "system"), (1, "assistant")],
    10: [(t, "user" if t % 2 == 0 else "assistant") for t in range(52)],
}


@pytest.mark.parametrize(
    "name",
    ["fit_context", "request_outcomes", "outcome_counts", "conversation_round_trip", "chat_prompt", "validate_conversations", "sft_examples"],
)
def test_queries_on_long_conversations_equal_sql(spark, tmp_path, name):
    rows = [(c, t, role, f"w{t}") for c, own in LONG.items() for t, role in own]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    query, sql = chat_queries[name]
    assert differences(spark, con, query, sql, str(tmp_path)) is None


def talk(turns):
    """A message list of so many turns, the user first."""
    speakers = itertools.cycle(("user", "assistant"))
    return [{"role": next(speakers), "content": f"line {i} of {turns}"} for i in range(turns)]


U, A = {"role": "user", "content": "and then?"}, {"role": "assistant", "content": "it rained"}
MESSAGE_CASES = [
    ([U, A, U], None, None),
    ([U], None, None),
    ([], "no_messages", "messages must be a non-empty list"),
    (None, "no_messages", "messages must be a non-empty list"),
    ([{"role": "system", "content": "hi"}], "invalid_role",
     "message 0 has invalid role 'system'; must be 'user' or 'assistant'"),
    ([{"role": None, "content": "hi"}], "invalid_role",
     "message 0 has invalid role None; must be 'user' or 'assistant'"),
    ([{"role": "user", "content": ""}], "empty_content", "message 0 must have non-empty string 'content'"),
    ([U, {"role": "assistant", "content": None}], "empty_content", "message 1 must have non-empty string 'content'"),
    ([U, U], "wrong_turn",
     "messages must alternate starting with 'user'; message 1 has role 'user', expected 'assistant'"),
    ([A], "wrong_turn", "messages must alternate starting with 'user'; message 0 has role 'assistant', expected 'user'"),
    ([U, A], "ends_on_assistant", "messages must end on a 'user' turn"),
    (talk(51), "too_many_messages", "messages has 51 entries, exceeds limit of 50"),
    (talk(49), None, None),
    ([{"role": "user", "content": "x" * 8001}], "content_too_long",
     "message 0 content is 8001 chars, exceeds limit of 8000"),
    ([{"role": "user", "content": "🎉" * 8000}], None, None),
]


def test_message_rules(spark):
    rows = [(i, case[0]) for i, case in enumerate(MESSAGE_CASES)]
    df = spark.createDataFrame(rows, f"i int, m {MESSAGES_TYPE}")
    for r in df.select("i", messages_error(F.col("m")).alias("e")).collect():
        _, code, text = MESSAGE_CASES[r["i"]]
        assert (r["e"] and tuple(r["e"])) == (code and (code, text)), r["i"]


def test_fit_context_drops_whole_pairs(spark):
    messages = [U, A, U, A, U]
    df = spark.createDataFrame([(messages,)], f"m {MESSAGES_TYPE}")
    sizes = [len(encoded(m["role"], m["content"])) for m in messages]
    opener = len("<|assistant|>\n")
    counts = F.array(*map(F.lit, [*sizes, opener]))

    def fit(limit):
        return df.select(fit_context(F.col("m"), counts, F.lit(10), limit).alias("f")).first()["f"]

    full = sum(sizes) + opener + 10
    assert tuple(fit(full)) == (0, full - 10)
    assert fit(full - 1)["first"] == 2
    assert fit(sizes[-1] + opener + 10)["first"] == 4
    assert fit(sizes[-1] + opener + 9) is None


PARAMETERS = [
    ({}, (50, 1.0, 1.0, 0, 1.0)),
    ({"max_new_tokens": 100, "temperature": 0.5}, (100, 0.5, 1.0, 0, 1.0)),
    ({"max_new_tokens": 10000}, (512, 1.0, 1.0, 0, 1.0)),
    ({"max_new_tokens": -3}, (-3, 1.0, 1.0, 0, 1.0)),
    ({"max_new_tokens": 10.7}, (10, 1.0, 1.0, 0, 1.0)),
    ({"top_k": -5.5, "max_new_tokens": True}, (1, 1.0, 1.0, 0, 1.0)),
    ({"max_new_tokens": " 64 ", "top_k": "1_0"}, (64, 1.0, 1.0, 10, 1.0)),
    ({"max_new_tokens": "9" * 40, "top_k": "-" + "9" * 40}, (512, 1.0, 1.0, 0, 1.0)),
    ({"temperature": -1.0}, (50, 0.0, 1.0, 0, 1.0)),
    ({"temperature": 5.0}, (50, 2.0, 1.0, 0, 1.0)),
    ({"temperature": 1e-45}, (50, 0.01, 1.0, 0, 1.0)),
    ({"temperature": 0.005}, (50, 0.01, 1.0, 0, 1.0)),
    ({"temperature": 0.0}, (50, 0.0, 1.0, 0, 1.0)),
    ({"temperature": 0.02}, (50, 0.02, 1.0, 0, 1.0)),
    ({"temperature": "nan"}, (50, 0.01, 1.0, 0, 1.0)),
    ({"temperature": "inf", "repetition_penalty": "nan"}, (50, 2.0, 1.0, 0, 1.0)),
    ({"temperature": "1e-1"}, (50, 0.1, 1.0, 0, 1.0)),
    ({"top_p": 1.5}, (50, 1.0, 1.0, 0, 1.0)),
    ({"top_p": 0}, (50, 1.0, 1.0, 0, 1.0)),
    ({"top_p": -1.0}, (50, 1.0, 1.0, 0, 1.0)),
    ({"top_p": 0.5, "top_k": 40}, (50, 1.0, 0.5, 40, 1.0)),
    ({"repetition_penalty": 0.5}, (50, 1.0, 1.0, 0, 1.0)),
    ({"repetition_penalty": 10}, (50, 1.0, 1.0, 0, 2.0)),
    ({"repetition_penalty": 1.3}, (50, 1.0, 1.0, 0, 1.3)),
]
BAD_PARAMETERS = [
    ({"max_new_tokens": "abc"}, "invalid literal for int() with base 10: 'abc'"),
    ({"max_new_tokens": "10.7"}, "invalid literal for int() with base 10: '10.7'"),
    ({"temperature": "warm", "top_k": "x"}, "could not convert string to float: 'warm'"),
    ({"temperature": None}, "float() argument must be a string or a real number, not 'NoneType'"),
    ({"top_k": None}, "int() argument must be a string, a bytes-like object or a real number, not 'NoneType'"),
    ({"top_p": [1]}, "float() argument must be a string or a real number, not 'list'"),
    ({"top_p": {"a": 1}}, "float() argument must be a string or a real number, not 'dict'"),
]


def outcomes(spark, payloads, **options):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, payload string")
    return {r["i"]: r for r in request_outcomes(df, **options).collect()}


def test_request_parameters(spark):
    payloads = [json.dumps({"input": {"messages": [U], **p}}) for p, _ in PARAMETERS + BAD_PARAMETERS]
    got = outcomes(spark, payloads)
    for i, (given, want) in enumerate(PARAMETERS):
        r = got[i]
        values = tuple(r[n] for n in ("max_new_tokens", "temperature", "top_p", "top_k", "repetition_penalty"))
        assert (values, r["outcome"]) == (want, "accepted"), given
    for i, (given, error) in enumerate(BAD_PARAMETERS, len(PARAMETERS)):
        assert (got[i]["outcome"], got[i]["error"]) == ("invalid_parameter", error), given


def test_request_outcome_order(spark):
    bad = {"role": "user", "content": 5}
    got = outcomes(
        spark,
        [
            *(json.dumps({"input": x}) for x in ("not a dict", ["a"], None, 42, {})),
            "{}",
            "not json",
            json.dumps({"input": {"messages": [], "max_new_tokens": "abc"}}),
            json.dumps({"input": {"messages": "no list"}}),
            json.dumps({"input": {"messages": [bad]}}),
            json.dumps({"input": {"messages": [7]}}),
            json.dumps({"input": {"messages": [{"role": "user", "content": "x" * 3000}]}}),
            json.dumps({"input": {"messages": [{"role": "user", "content": "x" * 1900}, A, U]}}),
        ],
    )
    for i in range(7):
        assert (got[i]["outcome"], got[i]["error"]) == ("no_messages", "messages must be a non-empty list")
    assert [got[i]["outcome"] for i in range(7, 13)] == [
        "invalid_parameter", "no_messages", "empty_content", "invalid_role", "context_too_long", "accepted"
    ]
    assert got[12]["kept_turns"] == 3
    short = outcomes(spark, [json.dumps({"input": {"messages": [{"role": "user", "content": "x" * 1900}, A, U]}})], max_seq_len=500)
    assert short[0]["kept_turns"] == 1 and short[0]["prompt"] == "<|user|>\nand then?\n<|assistant|>\n"


def test_roles_that_are_no_strings_are_shown(spark):
    roles = [5, 1.5, True, None, "it's"]
    got = outcomes(spark, [json.dumps({"input": {"messages": [{"role": r, "content": "x"}]}}) for r in roles])
    for i, role in enumerate(roles):
        assert got[i]["error"] == f"message 0 has invalid role {role!r}; must be 'user' or 'assistant'"


def test_turn_counts_add_up_to_the_whole_prompt(spark):
    """The context check adds counts per turn; the prompt must not encode differently as a whole."""
    from tessera.operators.encoding import encode_ids

    def said(tail):
        texts = ("how are you doing today", "I am doing well", "hi")
        return [(("user", "assistant")[i % 2], text + tail) for i, text in enumerate(texts)]

    tails = ["", " ", "\n", "\n\n", "  \n "]
    vocab = train_vocabulary(word_counts(turns(spark, {i: said(t) for i, t in enumerate(tails)})), 290)
    payloads = [json.dumps({"input": {"messages": [{"role": r, "content": c} for r, c in said(t)]}}) for t in tails]
    got = outcomes(spark, payloads, vocab=vocab)
    prompts = spark.createDataFrame([(i, r["prompt"]) for i, r in got.items()], "i int, p string")
    whole = prompts.select("i", F.size(encode_ids(F.col("p"), vocab, spark)).alias("n")).collect()
    assert {r["i"]: r["n"] for r in whole} == {i: r["used_tokens"] for i, r in got.items()}


def test_replies(spark):
    chunks = [("a", 0, "He", False, None), ("a", 1, "llo", False, None), ("a", 2, None, True, None),
              ("b", 0, None, True, "messages must be a non-empty list"), ("c", 0, "cut", False, None)]
    df = spark.createDataFrame(chunks, "request_id string, seq long, token string, done boolean, error string")
    got = {r["request_id"]: (r["reply"], r["status"]) for r in assemble_replies(df).collect()}
    assert got == {"a": ("Hello", "ok"), "b": ("", "error"), "c": ("cut", "incomplete")}


def test_preference_examples(spark):
    df = spark.createDataFrame([("what is 2+2", "4", "5[PAD]")], "prompt string, chosen string, rejected string")
    wrapped = preference_prompts(df)
    assert wrapped.first()["prompt"] == "<|user|>\nwhat is 2+2\n<|assistant|>\n"
    r = preference_examples(wrapped, max_length=64).first()
    n = len(r["prompt_ids"])
    assert r["chosen_ids"][n:] == [IDS[ord("4")], PAD_ID] + [PAD_ID] * (62 - n)
    assert r["rejected_ids"][n : n + 2] == [IDS[ord("5")], PAD_ID]
    assert r["chosen_mask"] == [0] * n + [1, 1] + [0] * (62 - n)
    assert len(r["rejected_ids"]) == len(r["rejected_mask"]) == 64


def test_byte_count_of_markup(spark):
    n = spark.range(1).select(byte_token_count(format_prompt(F.lit("é")))).first()[0]
    assert n == len("<|user|>\né\n<|assistant|>\n".encode())
