"""Alignment of two tokenizers next to a plain walk over both sides."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from conftest import rows
from curfew.llm import token_alignment
from llm.conftest import SMALL

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(pairs):
    """The rows of the report, with the tokenizers' own libraries and no vectorised step."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(PATHS[0])
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = token_alignment.byte_letters()

    def bytes_of(piece, i):
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    def cuts(parts):
        end, out = 0, []
        for part in parts:
            end += len(part)
            out.append(end)
        return out

    found, held = [], Counter()
    for doc_id, text in pairs:
        groups, links, n_a, n_b = [], Counter(), 0, 0
        if text:
            a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
            a_bytes = [bytes(letters[c] for c in a_side.id_to_token(i)) for i in a]
            b_bytes = [bytes_of(b_side.id_to_piece(i), i) for i in b]
            if b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
                n_a, n_b = len(a), len(b)
                a_ends, b_ends = cuts(a_bytes), cuts(b_bytes)
                last = 0
                for end in sorted(set(a_ends) & set(b_ends)):
                    x = [i for i, e in zip(a, a_ends) if last < e <= end]
                    y = [i for i, e in zip(b, b_ends) if last < e <= end]
                    groups.append((x, y))
                    links.update((p, q) for p in x for q in y)
                    last = end
        held.update(links.keys())
        found.append((doc_id, n_a, n_b, groups, links))
    best = defaultdict(int)
    for (p, _), n in held.items():
        best[p] = max(best[p], n)
    out = []
    for doc_id, n_a, n_b, groups, links in found:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc_id, n_a, n_b, len(groups), sum(links.values()),
            sum(n for pair, n in links.items() if held[pair] == best[pair[0]]),
            sum(n * held[pair] for pair, n in links.items()),
            hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def report(docs):
    found = token_alignment.report(docs, *PATHS)
    assert found.columns == COLUMNS
    return sorted(rows(found), key=repr)


@pytest.mark.parametrize("common", [token_alignment.COMMON_PAIRS, 200, 0])
def test_small_table(spark, monkeypatch, common):
    """Whole table; with pairs that workers know, with some by the join, and with all by the join."""
    monkeypatch.setattr(token_alignment, "COMMON_PAIRS", common)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("n_chars < 1500")
    assert report(docs) == plain(rows(docs.select("doc_id", "text")))


def test_pairs_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "PAIRS_AT_ONCE", 3)
    monkeypatch.setattr(token_alignment, "FOLDED", 5)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("n_chars < 200")
    assert report(docs) == plain(rows(docs.select("doc_id", "text")))


def test_odd_rows(docs_of, no_docs):
    """Null ids and texts, empty ones, special tokens as text, marks that a side changes, repeated rows, long
    texts without common ends, and clashing columns."""
    pairs = [
        (None, "some words"), (1, None), (2, ""), (3, "a <|endoftext|> <s> </s> <unk> <0x41> b"), (4, "one▁two"),
        (5, " \n\t  \r\n"), (6, "ﬁne 全角 Ａ é é"), (7, "same"), (7, "same"), (8, "\u0000x​"), (9, "  " * 3001 + "x" * 777),
        (10, "日本語のテキスト 😀👍🏽"),
    ]
    assert report(docs_of(*pairs)) == plain(pairs)
    assert report(no_docs) == []


def test_groups():
    import numpy as np

    a, b = token_alignment.groups(np.array([2, 5, 6, 9]), np.array([3, 6, 7, 8, 9]))
    assert a.tolist() == [0, 0, 0, 1] and b.tolist() == [0, 0, 1, 1, 1]
