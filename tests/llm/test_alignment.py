"""Alignment of tokenizers against token-by-token brute force."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sentrail.llm import alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "plain words here", "<|endoftext|> <s> </s> <unk> <0x41>", "tab\tand\nbreaks\r\n", "日本語 ünï “x” 🙂🙃", "▁ lower block", "x" * 5000, "  two  blanks ",
    "a\x00b", "ﬁne ①", "1234567890 12,345.67", "the cat the cat", "the cat the cat", "﻿bom", "é é",
]


def _bytes():
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    letters = [k for k in range(256) if 33 <= k <= 126 or 161 <= k <= 172 or k >= 174]
    of = {chr(k): k for k in letters}
    of.update({chr(256 + n): k for n, k in enumerate(k for k in range(256) if k not in letters)})

    def one(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        return ids, [bytes(of[c] for c in a.id_to_token(i)) for i in ids]

    def two(text):
        ids = b.encode(text)
        return ids, [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids]

    return one, two


def _spans(parts):
    ends = np.cumsum([len(part) for part in parts]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def _expected(texts):
    one, two = _bytes()
    made, counts = [], Counter()
    for text in texts:
        (a, parts_a), (b, parts_b) = (one(text), two(text)) if text else (([], []), ([], []))
        whole = (" " + (text or "")).encode()
        if not text or b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            made.append(([], [], [], []))
            continue
        spans_a, spans_b = _spans(parts_a), _spans(parts_b)
        links, k = [], 0
        for i, (low, high) in enumerate(spans_a):
            while spans_b[k][1] <= low:
                k += 1
            j = k
            while j < len(b) and spans_b[j][0] < high:
                links.append((a[i], b[j]))
                j += 1
        cuts = sorted({end for _, end in spans_a} & {end for _, end in spans_b})
        groups, low = [], 0
        for cut in cuts:
            groups.append(([i for i, s in zip(a, spans_a, strict=True) if low <= s[0] < cut], [i for i, s in zip(b, spans_b, strict=True) if low <= s[0] < cut]))
            low = cut
        counts.update(set(links))
        made.append((a, b, groups, links))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(n, best.get(i, 0))
    for a, b, groups, links in made:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        sums = sum(counts[pair] == best[pair[0]] for pair in links), sum(counts[pair] for pair in links)
        yield (len(a), len(b), len(groups), len(links), *sums, hashlib.sha256(said.encode()).hexdigest() if said else "")


@pytest.mark.parametrize("max_bytes", [128 << 20, 64])
def test_report_equals_brute_force(spark, max_bytes):
    rows = [(k if k % 5 else None, text, "x", 0, "y") for k, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ROW string, times long, a string").repartition(3)
    found = alignment.alignment_report(docs, *PATHS, max_bytes=max_bytes).collect()
    expected = sorted(((k if k % 5 else None, *row) for k, row in enumerate(_expected(TEXTS))), key=str)
    assert sorted(map(tuple, found), key=str) == expected


def test_documents_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [row for row in docs.collect() if len(row[1]) < 4000]
    found = alignment.alignment_report(spark.createDataFrame(rows, docs.schema), *PATHS).collect()
    assert sorted(map(tuple, found)) == sorted((doc, *row) for (doc, _), row in zip(rows, _expected([text for _, text in rows]), strict=True))


def test_parts_have_the_tokens_of_the_whole():
    """Random texts of words, marks, blanks and white space of every kind."""
    random = np.random.default_rng(12)
    pieces = ["the", "Été", "don't", "'s", "日本", "x1", "42", "…", "🙂", "-", ".", ",", "_", "ß", "\u200b", "\u0301", "I'll", "<s>", "▁", "\x7f", "\x00", "é", "À"]
    spaces = [" ", " ", " ", " ", "  ", "\n", "\t", "\xa0", "\u2003", "\u3000", "\x85", "\u2028", " \n ", "\x0b", "\x1c", "\u1680", "\r\n", "\u205f", ""]
    texts = ["".join(str(random.choice(part)) for _ in range(int(random.integers(1, 25))) for part in (pieces, spaces)) for _ in range(3000)]
    texts += [str(random.choice(spaces)) + text for text in texts[:300]] + TEXTS
    tokenizers = alignment.Tokenizers(*PATHS)
    assert tokenizers.cut
    a, b = tokenizers.encode([text or "" for text in texts])
    for most in (1 << 27, 0):
        parts = alignment.Parts(tokenizers, most)
        for low in range(0, len(texts), 1500):
            some = slice(low, low + 1500)
            places, of = parts.of(pa.array(texts[some]))
            for side, expected in (("a", a), ("b", b)):
                bounds = alignment._bounds(parts.sizes[side][places], of)
                found = np.split(parts.take(side, side, places), bounds[1:-1])
                assert [x.tolist() for x in found] == [list(x) for x in expected[some]]


def test_alignments(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    digests = [row[-1] for row in _expected(TEXTS)]
    for row in alignment.alignments(docs, *PATHS).collect():
        groups = {}
        for side in ("a", "b"):
            for token, group in zip(row[f"{side}_ids"], row[f"{side}_groups"], strict=True):
                groups.setdefault(group, {"a": [], "b": []})[side].append(str(token))
        said = ";".join(",".join(groups[k]["a"]) + "|" + ",".join(groups[k]["b"]) for k in range(len(groups)))
        assert (hashlib.sha256(said.encode()).hexdigest() if said else "") == digests[row["doc_id"]]


def test_terminals_of_random_cuts():
    random = np.random.default_rng(8)
    for _ in range(50):
        total = int(random.integers(1, 200))
        ends = [np.append(np.flatnonzero(random.random(total - 1) < 0.3) + 1, total) for _ in range(2)]
        last = alignment.terminals(*ends)
        cuts = np.intersect1d(*ends)
        for side, found in zip(ends, np.split(last, [len(ends[0])]), strict=True):
            assert ends[0][found].tolist() == cuts[np.searchsorted(cuts, side)].tolist()


def test_empty_table(spark):
    assert alignment.alignment_report(spark.createDataFrame([], "doc_id long, text string"), *PATHS).collect() == []
