"""Prefix tries, id files, alignments and exact set links against brute force and the public libraries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import alignment, decontaminate, idfiles, pages, prefixes, similar_sets, simhash, surrogates
from tessera.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = [*"aaabb  eethinngI'sS'll \n\t\r\x0b\x1c\x1f\x85\xa0éüñßİıΣσςÅ日本語😀１٢ⅷ²ǅʰ́​　--..!!$$90ÀŸ▁", "<|endoftext|>", "<s>", "<0x41>", " the", "ΑΣ "]


def odd_texts(n, seed, length=40):
    pick = random.Random(seed)
    return ["".join(pick.choice(SIGNS) for _ in range(pick.randint(0, length))) for _ in range(n)]


# -- prefix trie ----------------------------------------------------------------------------------


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [t[2:] for t in sorted(held, key=lambda t: t[:2])] for conv, held in turns.items()}
    members, paths = defaultdict(list), {}
    for conv in own:
        first = zlib.crc32(str(conv).encode()) % 9
        paths[conv] = tuple(own.get(conv - conv % 5, [])[:first] + own[conv][first:])
        for depth in range(len(paths[conv]) + 1):
            members[paths[conv][:depth]].append(conv)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for path, held in members.items():
        for depth in range(len(path) + 1):
            saved[path[:depth]] += (len(held) - 1) * (len(path[-1][1].encode()) if path else 0)
            leaves[path[:depth]] += not children[path]
    return sorted(
        (
            (
                min(held), len(path), min(members[path[:-1]]) if path else None, len(held), children[path], leaves[path], saved[path],
                hashlib.sha256(",".join(str(c) for c in sorted(held) if len(paths[c]) == len(path)).encode()).hexdigest(),
            )
            for path, held in members.items()
        ),
        key=repr,
    )


def talks(seed, n, longest, texts):
    pick = random.Random(seed)
    rows = []
    for conv in [*pick.sample(range(-20, 2 * n), n), None]:
        for turn in range(pick.randint(1, longest)):
            number = None if turn == 0 and pick.random() < 0.2 else turn + 1
            rows.append((conv, number, pick.choice(["user", "assistant", None]), pick.choice(texts), number))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize(("longest", "texts"), [(3, ["x"]), (14, ["x", "yé", None, ""]), (4, ["long " * 5000, "b"])])
def test_trie_equals_brute_force(spark, longest, texts):
    rows = talks(longest, 160, longest, texts)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth long").repartition(5)
    assert sorted(map(tuple, prefixes.prefix_trie(table).collect()), key=repr) == brute_trie([r[:4] for r in rows])


def test_trie_of_a_path_that_shards_share(spark, monkeypatch):
    """A third of the conversations are the same one, longer than the skeleton may hold; ids are sent in chunks."""
    monkeypatch.setattr(prefixes, "CHUNK", 64)
    for turns in (prefixes.SKELETON_TURNS, 8):
        monkeypatch.setattr(prefixes, "SKELETON_TURNS", turns)
        rows = [(conv, turn, "user", f"t{turn}", 0) for conv in range(0, 400, 5) for turn in range(12)]
        rows += talks(3, 150, 6, ["a", "b", "c"])
        table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth long")
        table = table.dropDuplicates(["conv_id", "turn"]).cache()
        want = brute_trie([tuple(r)[:4] for r in table.collect()])
        assert sorted(map(tuple, prefixes.prefix_trie(table).collect()), key=repr) == want


def test_trie_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefixes.prefix_trie(spark.createDataFrame([], schema)).collect() == []
    assert prefixes.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).collect() == []


# -- id files -------------------------------------------------------------------------------------


def test_words_round_trip():
    pick = random.Random(1)
    kinds = [0, 0, 0, 1, 1, 3, 7, 100, 5000, 49407, 2**31, 2**59, 2**60 - 1, 2**60, 2**64 - 1]
    for _ in range(300):
        docs = [[pick.choice(kinds if pick.random() < 0.5 else [0, 1]) for _ in range(pick.choice([0, 1, 2, 5, 130, 300]))] for _ in range(pick.randint(1, 6))]
        ids, counts = np.array(sum(docs, []), np.uint64), np.array([len(d) for d in docs])
        words, ends = idfiles.packed(ids, np.cumsum(counts))
        assert idfiles.unpacked(words, counts, ends).tolist() == ids.tolist()
        assert (words >> np.uint64(60) == 0).any() == bool((ids >= 2**60).any())


def test_words_hold_as_many_ids_as_fit():
    for selector in range(2, 16):
        bits, count = int(idfiles.BITS[selector]), int(idfiles.COUNTS[selector])
        ids = np.full(3 * count, (1 << bits) - 1, np.uint64)
        words, _ = idfiles.packed(ids, np.array([len(ids)]))
        assert len(words) == 3 and set((words >> np.uint64(60)).tolist()) == {selector}


def test_damaged_files_are_errors():
    data = idfiles.block_of(0, 0, [idfiles.Document(7, 0, b""), idfiles.Document(None, 2, bytes(8))]) + b"\n"
    assert [b.keys for b in idfiles.blocks_in(data)] == [[7, None]]
    for bad in (data[:-9], data[:20] + b"\x01" + data[21:], b"x" + data):
        with pytest.raises(ValueError):
            list(idfiles.blocks_in(bad))


def test_ids_equal_the_public_library_on_odd_strings():
    from tokenizers import Tokenizer

    theirs, ours = Tokenizer.from_file(WORDS), idfiles.Library(WORDS)
    assert ours.cut
    for text in [*odd_texts(1500, 2), *(f"A{chr(c)}b {chr(c)}'s" for c in range(1, 0x250))]:
        assert ours.encode(pa.array([text]))[0].tolist() == theirs.encode(text, add_special_tokens=False).ids, text
    texts = odd_texts(50, 5)
    whole = idfiles.Library(WORDS)
    whole.cut, whole.latin = False, None  # the way for files with other steps
    assert whole.encode(pa.array(texts))[0].tolist() == ours.encode(pa.array(texts))[0].tolist()


def test_id_files_equal_the_library(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(idfiles, "BLOCK_BYTES", 200)
    monkeypatch.setattr(idfiles, "BLOCKS_PER_FILE", 2)
    monkeypatch.setattr(idfiles, "SHARD_GROUP", 3)
    texts = odd_texts(60, 3)
    rows = [(None, t, 1) for t in texts[:20]] + [(7, t, 2) for t in texts[20:50]] + [(7, "same", 3)] * 4
    rows += [(i, t, 4) for i, t in enumerate(texts[50:])] + [(-5, None, 5), (90, "", 5), (91, "long words " * 30_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(6)
    got = sorted(idfiles.id_files(docs, WORDS, 1, scratch_path(spark, "test")).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    lib = Tokenizer.from_file(WORDS)
    want = Counter()
    for key, text, _ in rows:
        ids = np.array(lib.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want[key, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert idfiles.id_files(docs.limit(0), WORDS, 1, scratch_path(spark, "test")).collect() == []


# -- alignment ------------------------------------------------------------------------------------


def brute_alignments(rows):
    tools = alignment.Aligner(BYTES, PIECES)
    found = []
    for key, text in rows:
        a = tools.first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tools.second.encode(text) if text else []
        parts = [[tools.a_bytes[i] for i in a], [tools.b_bytes[i] for i in b]]
        if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
            found.append((key, None))
            continue
        (ends_a, ends_b) = (np.cumsum([len(x) for x in p]).tolist() for p in parts)
        starts_a, starts_b = ([0, *ends[:-1]] for ends in (ends_a, ends_b))
        links = [(x, y) for x, s, e in zip(a, starts_a, ends_a) for y, t, f in zip(b, starts_b, ends_b) if s < f and t < e]
        groups, before = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            sides = ([str(x) for x, s, e in zip(ids, starts, ends) if before <= s and e <= cut] for ids, starts, ends in ((a, starts_a, ends_a), (b, starts_b, ends_b)))
            groups.append("|".join(map(",".join, sides)))
            before = cut
        found.append((key, (len(a), len(b), groups, links)))
    counts = Counter(pair for _, row in found if row for pair in set(row[3]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for key, row in found:
        if row is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = row
        sums = sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links)
        out.append((key, n_a, n_b, len(groups), len(links), *sums, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=repr)


ALIGNED = [
    (1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "a▁b"), (6, "<|endoftext|> <s> <0x41> </s>"), (7, "日本語 😀 é\n\n\ttab"),
    (8, "x"), (8, "x"), (None, "x y"), (9, "\x00 null"), (10, "aaaaaaaaaaaa " * 120), (11, "lines\r\nwith\rreturns \r"), (12, "{\r\n}"),
    *((100 + i, t) for i, t in enumerate(odd_texts(40, 4))),
]


@pytest.mark.parametrize("lot", [1 << 22, 150])
def test_alignments_equal_brute_force(spark, monkeypatch, lot):
    """In one lot, and in many, which takes a pass for each."""
    monkeypatch.setattr(alignment, "LOT_KEYS", lot)
    if lot < 1000:  # parts stay as many as for whole vocabularies
        monkeypatch.setattr(alignment, "least_parts", lambda tools: 12)
    rows = [(k, t, "r", 1) for k, t in (ALIGNED if lot > 1000 else ALIGNED[:16])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, n_a long").repartition(3)
    got = sorted(map(tuple, alignment.alignments(docs, BYTES, PIECES).collect()), key=repr)
    assert got == brute_alignments([r[:2] for r in rows])
    assert alignment.alignments(docs.limit(0), BYTES, PIECES).collect() == []


def test_cut_texts_have_the_tokens_of_whole_ones():
    tools = alignment.Aligner(BYTES, PIECES)
    assert tools.pieces
    for text in filter(None, odd_texts(1500, 6)):
        cut = tools.cut(" " + text)
        assert "".join(cut) == " " + text
        assert tools.first_ids(cut)[0].tolist() == tools.first.encode(" " + text, add_special_tokens=False).ids
        assert "▁" in text or tools.second_ids(cut)[0].tolist() == tools.second.encode(text)


def test_perfect_hash_places_each_key_once():
    pick = np.random.default_rng(3)
    keys = np.unique(pick.integers(0, 1 << 62, 20_000).astype(np.uint64))
    part = alignment.part_of(keys, 7)
    rows = []
    for p in range(7):
        sizes, bits, ordered = alignment.leveled(keys[part == p])
        rows.append(type("Row", (dict,), {"__getattr__": dict.__getitem__})(part=p, sizes=sizes, bits=bits.tobytes(), keys=ordered.tobytes()))
    index = alignment.Index(7, rows)
    assert sorted(index.places(keys).tolist()) == list(range(len(keys)))
    assert (index.places(keys + np.uint64(1)) >= 0).sum() == np.isin(keys + np.uint64(1), keys).sum()


# -- exact links of sets --------------------------------------------------------------------------


@pytest.mark.parametrize("one_lot", [True, False])
def test_set_links_equal_brute_force_over_blocks(spark, monkeypatch, one_lot):
    monkeypatch.setattr(similar_sets, "BLOCK_SETS", 12)
    monkeypatch.setattr(similar_sets, "ANCHORS", 3)
    pick = random.Random(4)
    sets = []
    for n in (3, 20, 60, 25):
        core = [pick.randrange(1 << 60) for _ in range(60)]
        for _ in range(n):
            own = set(core)
            for _ in range(pick.choice([2, 5, 8, 14])):
                own.discard(pick.choice(core))
                own.add(pick.randrange(1 << 60))
            sets.append(own)
    lots = [0 if one_lot else i % 3 for i in range(len(sets))]
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if lots[i] == lots[j] and group[i] != group[j] and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    rows = [(i, lot, bytearray(np.array(sorted(s), "<u8").tobytes())) for i, (s, lot) in enumerate(zip(sets, lots))]
    table = spark.createDataFrame(rows, "node long, lot long, elements binary").repartition(5)
    links = similar_sets.similar_links(table, simhash.components, 0.8).collect()
    roots = {r.node: r.root for r in simhash.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert [roots.get(i, i) for i in range(len(sets))] == group


@pytest.mark.parametrize("n", [100, 200, 400])
def test_comparisons_of_dissimilar_copies_give_no_rows(n):
    pick = random.Random(n)
    sets = []
    for _ in range(n):
        own = list(range(300))
        for at in pick.sample(range(300), 6):
            own[at] = pick.randrange(1 << 40)
        runs = (hash(tuple(own[i : i + 5])) & 0xFFFFFFFF for i in range(296))
        sets.append(np.unique(np.array(list(runs), np.uint64)))
    assert len(similar_sets.links_within(sets, 0.8)) < n


def test_near_copies_allow_any_other_column(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text, "a", 1, 2, "k"), (2, text + " more", "b", 1, 2, "k"), (3, "another text of its own kind", "c", 1, 2, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone string, first int, root int, key string")
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


# -- pages, test items, secrets -------------------------------------------------------------------

ARTICLE = "<h1>One title</h1><p>First paragraph of words that stand here.</p><p>Second paragraph, some more of them.</p>"
TEXT = "One title First paragraph of words that stand here. Second paragraph, some more of them."


@pytest.mark.parametrize("mark", ["comments", "comment-list", "comments-area", "cookie-banner", "share_buttons"])
@pytest.mark.parametrize("holder", ["article", "div"])
def test_marked_elements_of_any_size_go(mark, holder):
    more = f"<div class='x {mark}'>" + "<p>A long remark of some reader who has a lot to say.</p>" * 6 + "</div>"
    assert pages.main_text(f"<html><body><{holder}>{ARTICLE}</{holder}>{more}</body></html>") == TEXT
    assert pages.main_text(f"<html><body><{holder}>{ARTICLE}{more}</{holder}></body></html>") == TEXT


def test_the_whole_article_stays():
    rows = "<table>" + "<tr><td>Cell</td><td>12</td></tr>" * 50 + "</table><ul><li><a href=/a>Link</a></li></ul><p>End.</p>"
    want = f"{TEXT} {'Cell 12 ' * 50}Link End."
    assert pages.main_text(f"<html><body><nav>Menu</nav><div>Loose words before.</div><article>{ARTICLE}{rows}</article></body></html>") == want
    for name in ("site-content no-sidebar", "wrapper ad-free", "page header-fixed"):
        assert pages.main_text(f"<html><body><div class='{name}'>{ARTICLE}<p class='share-price'>It rose.</p></div></body></html>") == TEXT + " It rose."


def test_items_of_one_id_and_of_none_are_all_found(spark, monkeypatch):
    texts = ["What colour is the northern harbour light? It is a deep and steady green.", "Who built the old stone bridge there? Masons from the upper valley did."]
    items = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (None, texts[0] + " Always."), (2, None)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"Some words before. {t} Some words after.") for i, t in enumerate(texts)] + [(9, "clean words")], "doc_id long, text string")
    for shard in (decontaminate.SHARD, 1):
        monkeypatch.setattr(decontaminate, "SHARD", shard)
        assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()} >= {(0, 1), (1, 1), (0, None)}
        assert [r.doc_id for r in decontaminate.without_leaks(docs, items).collect()] == [9]
        assert decontaminate.without_leaks(docs.limit(0), items).collect() == []


def test_secrets_that_differ_in_case_stay_different(spark):
    rows = [(1, "password: Hunter2222"), (2, "password: hunter2222"), (3, "password: Hunter2222"), (None, "token = ghp_AbCdEfGhIjKlMnOpQrStUvWxYz0123456789")]
    got = {r.doc_id: r.text for r in surrogates.replaced(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    assert got[1] == got[3] and got[1].lower() != got[2].lower() and "unter2222" not in got[1] + got[2]
    secret = got[None].split()[-1]
    assert secret.startswith("ghp_") and [c.isupper() for c in secret] == [c.isupper() for c in rows[3][1].split()[-1]]
