"""Cross-tokenizer alignment against whole texts and all overlaps."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfcast.llm import alignment
from shelfcast.llm.alignment import aligned, groups, links
from shelfcast.llm.queries import tokenizer_path
from shelfcast.llm.token_counts import byte_letters
from tests.llm.conftest import CLASHING, edge_rows, prose

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(rows, libraries):
    a, b = libraries
    back = {letter: n for n, letter in enumerate(byte_letters())}
    told, held = [], []
    for _, text in rows:
        pairs, shape, digest = [], (0, 0, 0, 0), ""
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            raw = (
                [bytes(back[c] for c in a.id_to_token(i)) for i in ids[0]],
                [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                 for i in ids[1]],
            )
            if b"".join(raw[0]) == b"".join(raw[1]) == (" " + text).encode():
                ranges = []
                for own in raw:
                    at, found = 0, []
                    for token in own:
                        found.append((at, at + len(token)))
                        at += len(token)
                    ranges.append(found)
                low = 0
                for i, (x0, x1) in enumerate(ranges[0]):
                    while ranges[1][low][1] <= x0:
                        low += 1
                    j = low
                    while j < len(ranges[1]) and ranges[1][j][0] < x1:
                        pairs.append((ids[0][i], ids[1][j]))
                        j += 1
                both = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
                parts, before = [], 0
                for end in both:
                    sides = [
                        ",".join(str(n) for n, (x0, x1) in zip(ids[s], ranges[s]) if before <= x0 and x1 <= end)
                        for s in (0, 1)
                    ] if len(text) < 5000 else ["", ""]
                    parts.append("|".join(sides))
                    before = end
                shape = (len(ids[0]), len(ids[1]), len(both), len(pairs))
                digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if len(text) < 5000 else None
        held.append(pairs)
        told.append((shape, digest))
    count = Counter(pair for pairs in held for pair in set(pairs))
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return [
        (key, *shape, sum(count[p] == most[p[0]] for p in pairs), sum(count[p] for p in pairs), digest)
        for (key, _), (shape, digest), pairs in zip(rows, told, held)
    ]


def compare(spark, rows, libraries, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    df = df.selectExpr("*", *[f"'no' AS {c}" for c in (*CLASHING, "pairs", "keys", "at", "n_a", "best")])
    got = aligned(df, A, B)
    assert tuple(got.columns) == COLUMNS
    want = brute(rows, libraries)
    long = {w[:7] for w in want if w[7] is None}
    got = [(*r[:7], None) if tuple(r[:7]) in long else tuple(r) for r in got.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


ODD = [
    "", " ", "  ", " a", "a ", "a  b", "a \n b", "\ta\tb", "a▁b c", "▁", "<s> x </s> <unk> <|endoftext|>", "<0x41> <0x0A>",
    "don't I'LL 'll x's", "naïve café é ﬁ ½ ①", "日本語 テキスト 🙂🙂 x", "a b　c d", "\x00 \x01x \x1f y",
    "1234567 12,5 3.1415", "a ́b", "x" * 300, "é" * 100 + " ok", "tab\t end", "trail \n", "\r\n a\r\nb", "a \x1c b", "\u0085 b c",
    "हिन्दी में पाठ", "ffi ﷽ ㎏ Å", "!!! ... ??? --- ===", "https://a.b/c?d=e&f#g",
]


def test_equals_whole_texts(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_WORDS", 150)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, prose(i, 5 + 20 * i)) for i in range(12)]
    rows += [(200 + i, f"{prose(3, 20)} {t} {prose(4, 9)}") for i, t in enumerate(ODD)]
    compare(spark, rows, libraries)


def test_edge_rows_repetitions_and_nothing(spark, libraries):
    rows = [(i, t) for i, t, *_ in edge_rows()] + [(1, None), (None, "same words"), (None, "same words")]
    compare(spark, rows, libraries)
    compare(spark, [], libraries)
    compare(spark, [(1, None), (2, ""), (3, "▁")], libraries)


def test_given_documents(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r) for r in aligned(docs, A, B).collect()}
    for want in brute(rows, libraries):
        assert got[want[0]][:7] == want[:7]
        assert want[7] is None or got[want[0]][7] == want[7]


def test_groups_and_links_of_ends():
    a, b = [2, 5, 6, 9], [1, 5, 7, 9]
    found = list(groups(a, b))
    assert found == [(5, 0, 2, 0, 2), (9, 2, 4, 2, 4)]
    assert [p for _, *own in found for p in links(a, b, *own)] == [(0, 0), (0, 1), (1, 1), (2, 2), (3, 2), (3, 3)]
