import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeline.llm.packing import pack, plan
from gaugeline.llm.tokens import Encoder
from tests.llm.corpora import TABLES, frame, odd_rows

ALPHABET = [" ", "  ", "\n", " \n", "\t", "a", "Bc", "é", "İ", "ß", "1", "23", "'s", "'", "don't", "|", "...", "!!", "$", "\u0301", "ı",
            "漢字", "🙂", " ", " ", "\x1c", "\x85", "\xa0", "<|endoftext|>", "<|startoftext|>", "_", "ǅ", "\u212a", "ﬁ", "word.", "X,y"]


def reference(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.mark.parametrize(("name", "spaces"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_equal_the_tokenizers(spark, name, spaces):
    chance, tokenizer = random.Random(3), reference(name)
    encoder = Encoder(public_tokenizers.path(name), spaces)
    texts = ["".join(chance.choices(ALPHABET, k=chance.randrange(14))) for _ in range(5000)]
    texts += ["", " ", "  ", "\n", " a", "a ", "  a  b  "]
    texts += [r["text"] for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("text").limit(50).collect()]
    texts += ["a <|endoftext|> b", "<|startoftext|>x", "<|ENDOFTEXT|> <|endoftext", "a<|endoftext|><|endoftext|>\n<|", "320 <| endoftext|> 321"]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def one_by_one(lengths, capacity):
    """The same packing, one sequence after another."""
    left, bins = Counter(lengths), []
    while +left:
        used, gap = Counter(), capacity
        while True:
            fits = [x for x in left if x <= gap and left[x] > used[x]]
            if not fits:
                break
            used[max(fits)] += 1
            gap -= max(fits)
        while gap:
            smallest, free = min(+used), left - used
            pairs = [(a + b, a, b) for a in free for b in free if a >= b and smallest < a + b <= gap + smallest and (a != b or free[a] > 1)]
            if not pairs:
                break
            best = max(pairs)
            used[smallest] -= 1
            used[best[1]] += 1
            used[best[2]] += 1
            gap += smallest - best[0]
        bins.append(+used)
        left -= used
    return bins


def test_plan_packs_like_one_sequence_after_another():
    chance = random.Random(5)
    for _ in range(30):
        lengths = [chance.randint(1, 40) for _ in range(chance.randint(1, 120))]
        fillings = plan(Counter(lengths), 40)
        assert sum((Counter({x: n * times for x, n in used.items()}) for times, used in fillings), Counter()) == Counter(lengths)
        assert all(sum(x * n for x, n in used.items()) <= 40 for _, used in fillings)
        assert abs(sum(times for times, _ in fillings) - len(one_by_one(lengths, 40))) <= 1


def check(rows, docs, capacity):
    """Pieces cover each document, and sequences are gapless and fit; returns the number of sequences."""
    tokenizer = reference("byte_bpe_50k.json")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for doc_id, texts in docs.items():
        expected = Counter()
        for text in texts:
            ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
            at, piece = 0, 0
            while at < len(ids):
                size = len(ids) % capacity if at == 0 and len(ids) % capacity else capacity
                part = ids[at:at + size]
                expected[piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
                at, piece = at + size, piece + 1
        assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces[doc_id]) == expected
    for inside in sequences.values():
        at = 0
        for r in sorted(inside, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(sequences)


def test_documents_of_the_table(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").repartition(5)
    rows = pack(docs).collect()
    count = check(rows, {r["doc_id"]: [r["text"]] for r in docs.select("doc_id", "text").collect()}, 1024)
    assert count <= 1.03 * sum(r["length"] for r in rows) / 1024 + 1


def test_odd_rows(spark):
    rows = [*odd_rows(), (16, "x <|endoftext|> y<|startoftext|>", "en", "a"), (17, "<|endoftext|>" * 70, "en", "a")]
    docs = defaultdict(list)
    for i, text, *_ in rows:
        docs[i].append(text)
    check(pack(frame(spark, rows, 4), capacity=32).collect(), docs, 32)
    assert pack(frame(spark, odd_rows()).limit(0)).collect() == []
