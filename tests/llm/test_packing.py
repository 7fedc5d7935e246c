"""Packing: ids equal the tokenizer's own, every id in one piece, sequences gapless and well filled."""

import sys
import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from postlens.llm import packing
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
TOKENS = packing.WordTokens(PATH)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(), st.text(st.sampled_from("aB \n'!.,-é<|>_9")), st.text(st.characters(codec="ascii"))))
def test_ids_are_those_of_the_whole_text(text):
    text = text.encode("utf-8", "ignore").decode()
    own = np.frombuffer(next(iter(TOKENS.packed([text]))), "<u4").tolist()
    assert own == TOKENIZER.encode(text, add_special_tokens=False).ids + [1]


def test_remembered_words_stay_small(monkeypatch):
    """A worker remembers words of about 20 MB, whatever it reads."""
    tokens = packing.WordTokens(PATH)
    monkeypatch.setattr(tokens, "_learn", lambda new: tokens.known.update((w, bytes(8)) for w in new))
    for at in range(0, 400_000, 20_000):
        list(tokens.packed([" ".join(f"word{i}" for i in range(at, at + 20_000))]))
    assert sys.getsizeof(tokens.known) + sum(sys.getsizeof(w) + sys.getsizeof(i) for w, i in tokens.known.items()) < 25e6


def test_memory_is_bounded_when_a_caller_stops_at_its_last_text(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 50)
    tokens = packing.WordTokens(PATH)
    for at in range(0, 1000, 100):
        for _ in zip([1], tokens.packed([" ".join(f"w{i}" for i in range(at, at + 100))])):
            pass
    assert len(tokens.known) <= 50


def test_latin_letters_have_the_ids_of_the_whole_text():
    letters = "".join(map(chr, range(0xC0, 0x180)))
    words = [*letters, *(f"a{c}B{c}" for c in letters), *(f"{c}x,." for c in letters), *(f"{c}'s" for c in letters)]
    (found,) = packing.WordTokens(PATH).packed([" ".join(words)])
    assert list(array("I", found)) == TOKENIZER.encode(" ".join(words), add_special_tokens=False).ids + [1]


def test_special_strings_and_full_memory(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    tokens = packing.WordTokens(PATH)
    for text in ["<|endoftext|> a<|startoftext|>b", "á ́x \x1c y z   İ", "one two three four five six " * 3, "Don't stop!! (it's) a_b x-y, 'tis re'd A1 e.g. {x}~ `q`"]:
        own = np.frombuffer(*tokens.packed([text]), "<u4").tolist()
        assert own == TOKENIZER.encode(text, add_special_tokens=False).ids + [1]
    assert len(tokens.known) <= 3


def test_letters_are_encoded_once_for_all_capitals_and_signs():
    """Words of many texts that share their letters cost one call of the tokenizer's model."""
    tokens, calls = packing.WordTokens(PATH), []

    class Model:
        def tokenize(self, low, model=tokens.tokenizer.model):
            calls.append(low)
            return model.tokenize(low)

    class Counted:
        model, encode_batch_fast = Model(), tokens.tokenizer.encode_batch_fast

    tokens.tokenizer = Counted()
    texts = ["Zebra zebra, ZEBRA! Ängste", "zebra. ängste; ÄNGSTE", "(zebra zebra's"]
    for text, own in zip(texts, tokens.packed(texts)):
        assert list(array("I", own)) == TOKENIZER.encode(text, add_special_tokens=False).ids + [1]
    assert len(calls) == 2


def test_runs_of_rows_are_cut_by_bytes():
    batch = packing.pa.RecordBatch.from_pydict({"text": ["aaaa", None, "é", "b" * 9, "", "c"]})
    assert [p["text"].to_pylist() for p in packing.by_bytes(batch, "text", 6)] == [["aaaa", None, "é"], ["b" * 9], ["", "c"]]
    assert list(packing.by_bytes(batch.slice(0, 0), "text", 6)) == []


def test_first_fit_equals_linear_search():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 101, 500).tolist()
    room, plain = [], []
    for s in sizes:
        place = next((i for i, r in enumerate(room) if r >= s), len(room))
        if place == len(room):
            room.append(100)
        room[place] -= s
        plain.append(place)
    assert packing.first_fit(sizes, 100) == plain
    assert packing.first_fit([], 100) == [] and packing.first_fit([100], 100) == [0]


def test_pieces_and_sequences(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    odd = [(None, None), (None, ""), (10**15 + 1, "same"), (10**15 + 1, "same"), (10**15 + 2, "word " * 50_000)]
    docs = docs.union(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = packing.packed(docs.withColumn("_group", packing.F.lit(1)), PATH, group=64).collect()
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)
    want = defaultdict(int)
    for doc, text in texts:
        ids = np.array(TOKENIZER.encode(text, add_special_tokens=False).ids + [1], "<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            want[doc, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    got = defaultdict(int)
    sequences = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048
    assert sum(r.length for r in rows) / (2048 * len(sequences)) > 0.95
    assert packing.packed(docs.limit(0), PATH).count() == 0


def test_words_that_come_once_take_no_room(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 50)
    tokens = packing.WordTokens(PATH)
    for at in range(0, 1000, 100):
        list(tokens.packed([" ".join([*(f"once{i}" for i in range(at, at + 100)), *(f"often{i}" for i in range(20))])]))
    assert {b"often%d" % i for i in range(20)} <= tokens.known.keys()
