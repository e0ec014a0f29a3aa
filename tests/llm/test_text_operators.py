"""Sharding, token counts, token files, packing and mixing on defined edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfcast.llm import ans, packing, tokens
from shelfcast.llm.mixing import Mixture, mixed_sizes, swap_or_not
from shelfcast.llm.packing import packed
from shelfcast.llm.queries import tokenizer_path
from shelfcast.llm.sharding import permute, shard
from shelfcast.llm.token_counts import token_counts
from shelfcast.llm.token_files import token_digests
from shelfcast.llm.tokens import Encoder, load
from tests.llm.conftest import edge_rows, prose

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return load(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("n", [1, 2, 7, 97, 1000, 4097])
def test_permutation_is_one_and_has_an_inverse(spark, n):
    rows = permute(spark.range(n), "id", "p", n, 5)
    rows = permute(rows, "p", "back", n, 5, inverse=True).collect()
    assert sorted(r.p for r in rows) == list(range(n))
    assert all(r.back == r.id for r in rows)
    assert n < 1000 or sum(r.p == r.id for r in rows) < 20


def test_shards_are_even_and_reproducible(spark, edges, nothing):
    rows = shard(edges, 4).collect()
    assert len(rows) == len(edge_rows())
    assert max(Counter(r.shard for r in rows).values()) - min(Counter(r.shard for r in rows).values()) <= 1
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    again = shard(edges.repartition(5), 4).collect()
    key = [(r.doc_id, r.text_crc32, r.shard, r.slot) for r in rows]
    assert sorted(key, key=repr) == sorted([(r.doc_id, r.text_crc32, r.shard, r.slot) for r in again], key=repr)
    assert shard(nothing, 4).count() == 0


def test_counts_are_the_librarys(edges, nothing, library):
    rows = token_counts(edges, PATH).collect()
    want = Counter((i, len((t or "").encode()), len(ids_of(library, t))) for i, t, *_ in edge_rows())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want
    assert token_counts(nothing, PATH).count() == 0


def test_pieces_cut_at_spaces_encode_alike(library):
    texts = ["", " ", "  ", "a ", " a", "a  b", "a \n b", "\x1c a \x1c", "a <|endoftext|> b", "<|endoftext|>",
             " <|endoftext|>  x", "don't 'll ' s", "1 000 000", "ÄÖ ü x 　y", "tab\tin word", "x" * 300 + " y"]
    own = Encoder(PATH)
    for _ in range(2):  # new pieces, then remembered ones
        assert [np.frombuffer(b, own.dtype).tolist() for b in own.encode(texts)] == [ids_of(library, t) for t in texts]


def test_token_files_round_trip(edges, nothing, library):
    rows = token_digests(edges, PATH).collect()
    want = Counter()
    for i, t, *_ in edge_rows():
        ids = [*ids_of(library, t), 0]
        want[(i, len(ids), crc(ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    keys = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert token_digests(nothing, PATH).count() == 0


@pytest.mark.parametrize("n", [0, 1, ans.LANES, ans.LANES + 1, 300_000])
def test_ans_round_trip_and_checkpoints(n):
    symbols = np.random.default_rng(1).zipf(1.3, 400_000)
    symbols = symbols[symbols < 5000][:n].astype(np.uint16)
    coder = ans.Coder(ans.scaled(np.bincount(symbols, minlength=5000)))
    block = coder.encode(symbols)
    assert (coder.decode(block) == symbols).all()
    if n > ans.LANES * ans.EVERY:
        part = coder.decode(block, 1)
        assert (part == symbols[ans.LANES * ans.EVERY :]).all()
        with pytest.raises(ValueError):
            coder.decode(block[:-1] + bytes([block[-1] ^ 1]))


def test_too_many_symbols_are_an_error():
    with pytest.raises(ValueError, match="do not fit"):
        ans.scaled(np.ones((1 << 18) + 1, np.int64))


def test_scaled_frequencies_keep_rare_symbols():
    table = ans.scaled(np.array([10**9, 0, 1, 1]))
    assert table.sum() == 1 << ans.SCALE and table[1] == 0 and (table[[2, 3]] >= 1).all()


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_places_every_piece(edges, nothing, library, capacity):
    rows = packed(edges, PATH, capacity).collect()
    want = Counter()
    for i, t, *_ in edge_rows():
        ids, start = [*ids_of(library, t), 0], 0
        lengths = [len(ids)] if len(ids) <= capacity else (
            [len(ids) % capacity] * (len(ids) % capacity > 0) + [capacity] * (len(ids) // capacity))
        for piece, length in enumerate(lengths):
            want[(i, piece, start, length, crc(ids[start : start + length]))] += 1
            start += length
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    for s in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert packed(nothing, PATH, capacity).count() == 0


def unfolded(plan):
    bins = {}
    for length, low, high, first, per, at in plan:
        for rank in range(high - low):
            bins.setdefault(first + rank // per, []).append((at + rank % per * length, length))
    return bins


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    histogram = {100: 3, 60: 7, 41: 5, 30: 11, 7: 40, 1: 90}
    bins = unfolded(packing.best_fit(histogram, 100, 9, 5500 + 4500, rule=rule))
    assert Counter(x for b in bins.values() for _, x in b) == histogram
    for held in bins.values():
        assert sum(x for _, x in held) <= 100 and len(held) <= 9 and sum(x * x for _, x in held) <= 10_000
        at = 0
        for place, length in sorted(held):
            assert place == at
            at += length


def test_best_fit_is_close_to_the_bound():
    rng = np.random.default_rng(4)
    histogram = Counter(np.minimum(2048, rng.lognormal(6, 1, 4000).astype(int) + 1).tolist())
    bins = unfolded(packing.best_fit(histogram, 2048))
    assert len(bins) <= 1.01 * sum(k * v for k, v in histogram.items()) / 2048 + 1


def test_swap_or_not_permutes_each_size(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(n, i) for n in (1, 2, 5, 64, 100) for i in range(n)], "n long, x long")
    got = swap_or_not(rows, "x", "n", ["n"], 3).groupBy("n").agg(F.sort_array(F.collect_list("x")).alias("x")).collect()
    assert all(r.x == list(range(r.n)) for r in got)


def test_mix_meets_targets_and_limits(spark, edges, nothing):
    rows = mixed_sizes(edges).collect()
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in edge_rows()]
    assert sorted(r.size for r in rows) == sorted(words)
    assert all(r.taken <= 2 * r.size for r in rows)
    assert mixed_sizes(nothing).count() == 0
    many = spark.createDataFrame(
        [(i, prose(i, 40 + i % 300), s, ) for i in range(400) for s in ["abcdeé"[i % 6] if i % 7 else None]],
        "doc_id long, text string, source string",
    )
    rows = mixed_sizes(many).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixed_sizes(many.repartition(7)).collect()))
    source_of = {r.doc_id: r.source for r in many.collect()}
    total = sum(r.size for r in rows)
    seen = {}
    for source in set(source_of.values()):
        own = [r for r in rows if source_of[r.doc_id] == source]
        size = sum(r.size for r in own)
        (target,) = {r.target for r in own}
        assert {r.source_size for r in own} == {size}
        assert target <= 2 * size and abs(sum(r.taken for r in own) - target) <= 1 + 0.01 * target
        seen[source] = target
    assert len(seen) == 7 and abs(sum(seen.values()) - 1.5 * total) < 1e-6 * total


def test_mixed_texts_are_the_taken_words(spark):
    docs = spark.createDataFrame([(i, prose(i, 500), "ab"[i % 2]) for i in range(20)], "doc_id long, text string, source string")
    mix = Mixture(docs, carried=("doc_id", "text"))
    taken = {r.row_number: r.taken for r in mix.taken().collect()}
    copies = mix.texts().collect()
    for number, n in taken.items():
        own = [r for r in copies if r.row_number == number]
        assert sum(len(r.text.split()) for r in own) == n
        for r in own:
            assert set(r.text.split()) <= set(r.own.text.split())


def test_parts_of_texts_are_not_broadcast(spark):
    """Their number is not known when the join is planned: a few compressed rows can hold any number of them."""
    docs = spark.createDataFrame([(i, prose(i, 500), "ab"[i % 2]) for i in range(20)], "doc_id long, text string, source string")
    spans = Mixture(docs).spans
    assert spans.count() > 100
    spans.collect()
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("sources,words", [(3, 60), (300, 20), (40, 1), (25, 700)])
def test_small_sources_meet_their_targets(spark, sources, words):
    rows = [(10 * s + i, prose(s, words - words // 2 if i else words // 2), f"s{s:04d}") for s in range(sources) for i in range(2)]
    got = mixed_sizes(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = {}, {}
    for r in got:
        assert r.taken <= 2 * r.size
        taken[r.doc_id // 10] = taken.get(r.doc_id // 10, 0) + r.taken
        target[r.doc_id // 10] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.5 + 0.01 * target[s] for s in taken)
    if words > 10:
        assert abs(sum(taken.values()) - 1.5 * sources * words) <= 0.01 * 1.5 * sources * words


def test_counts_equal_the_library_on_every_character():
    """Each beside a contraction, where a letter and a sign are cut differently."""
    from shelfcast.llm.token_counts import Counter as Tokens

    own = Tokens(tokenizer_path())
    points = [c for c in range(1, 0x33500) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(points), 20_000):
        texts = [f"a{chr(c)}'s {chr(c)}b" for c in points[low : low + 20_000]]
        want = [len(e.ids) for e in own.library.encode_batch_fast(texts, add_special_tokens=False)]
        got = [own.count(t) for t in texts]
        assert got == want, [hex(ord(t[1])) for t, g, w in zip(texts, got, want) if g != w][:20]


def test_another_way_of_cutting_is_refused(tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers

    from shelfcast.llm.token_counts import Counter as Tokens

    other = Tokenizer.from_file(tokenizer_path())
    other.pre_tokenizer = pre_tokenizers.Whitespace()
    other.save(f"{tmp_path}/other.json")
    with pytest.raises(ValueError, match="byte-level"):
        Tokens(f"{tmp_path}/other.json")


def test_ids_by_distinct_pieces_equal_the_library(monkeypatch):
    """White space of all kinds, stops and special strings, while the memory of pieces is replaced again and again. A
    piece is remembered once and the two generations are bounded by what one slice adds."""
    monkeypatch.setattr(tokens, "KEPT", 50)
    monkeypatch.setattr(tokens, "SLICE", 200)
    own, rng = Encoder(tokenizer_path()), random.Random(9)
    parts = [" ", " ", " ", " ", "\n", "\n", "\t", "  ", "\r", "\x1c", "\x85", "\xa0", "\u3000", "\u200b", "\x00", "a", "The"]
    parts += ["word", "word,", "\xe9.", "\u4e2d\u6587", "don't", "12", ",", ".", "<|endoftext|>", "x" * 90]
    for size in (1, 4, 12, 60):
        texts = ["".join(rng.choices(parts, k=rng.randrange(size + 1))) for _ in range(400)]
        assert own.encode(texts) == [own.plain(text) for text in texts]
    assert own.encode([]) == []
    texts = [" ".join(f"w{i}" for i in range(at, at + 40)) for at in range(0, 8000, 40)]
    assert own.encode(texts) == [own.plain(text) for text in texts]
    assert len(own.young) + len(own.old) < 500


def test_remembered_pieces_are_columns_looked_up_once_a_slice(monkeypatch):
    """Texts with white space beside spaces share one lookup with the others, remembered pieces cost few bytes,
    long ones are not kept, and what was met before needs no new ids."""
    own, looked = Encoder(tokenizer_path()), []
    places = own._places
    monkeypatch.setattr(own, "_places", lambda distinct: looked.append(len(distinct)) or places(distinct))
    texts = [" ".join(f"w{i}" for i in range(at, at + 50)) + ("  x, y." if at % 100 else " x, y.") for at in range(0, 5000, 50)]
    texts += ["a " + "z" * 200 + " b", "one  \t two", "one,  two.  one"]
    want = [own.plain(text) for text in texts]
    assert own.encode(texts) == want
    assert len(looked) == 1
    assert own.young.nbytes / len(own.young) < 60
    assert "z" * 200 not in own.young["piece"].to_pylist()
    learned, learn = [], own._learn
    monkeypatch.setattr(own, "_learn", lambda new: learned.extend(new) or learn(new))
    assert own.encode(texts) == want
    assert learned == ["z" * 200]
    monkeypatch.setattr(tokens, "KEPT", 10)  # a generation is full: pieces come back from the old one
    assert own.encode(texts[:60]) == want[:60]
    assert learned == ["z" * 200] and len(own.old) > 4000
    assert own.encode(["w7, w8. w7"]) == [own.plain("w7, w8. w7")]


def test_packing_holds_few_rows_at_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "TOGETHER", 7)
    rows = [(i, prose(i, 5 + 40 * (i % 3)) if i % 5 else None) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(map(tuple, packing.pieces(frame, PATH, 64).collect()))
    own, want = Encoder(PATH), []
    for doc, text in rows:
        ids = [*np.frombuffer(own.plain(text or ""), own.dtype).tolist(), 0]
        start = 0
        for place, length in enumerate(packing.cut_lengths(len(ids), 64)):
            want.append((doc, place, start, length, crc(ids[start : start + length])))
            start += length
    assert got == sorted(want)
