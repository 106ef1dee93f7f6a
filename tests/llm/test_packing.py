import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablewright.llm.packing import TextTokens, fill_up, pack_documents, packed_digests, plan_packs, shortest_pack_first

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 31), st.integers(1, 40)), st.sampled_from([32, 50]))
def test_plan_places_every_length_once(histogram, size):
    plan, sequences = plan_packs(histogram, size), defaultdict(list)
    for length, count in histogram.items():
        for rank in range(count):
            at = 0
            for start, n, sequence, offset in sorted(plan.of(length, rank)):
                assert start == at and n > 0
                at += n
                sequences[sequence].append((offset, n))
            assert at == length
    assert sorted(sequences) == list(range(plan.packs))
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == size or at < size and at & (at - 1) == 0


def test_longest_first_wastes_little():
    rng = random.Random(3)
    histogram = defaultdict(int)
    for _ in range(20000):
        histogram[min(2047, int(rng.lognormvariate(5.5, 1)) + 1)] += 1
    packs = shortest_pack_first(histogram, 2048)
    room = sum(b.count * (2048 - b.used) for b in packs)
    assert room < 0.02 * sum(b.count * b.used for b in packs)
    assert sum(b.count * b.used for b in fill_up(packs, 2048)) == sum(k * n for k, n in histogram.items())


def test_ids_equal_the_tokenizer():
    texts = ["", " \t", "Don't STOP, it's 2024... naïve façade—“quoted” £5½ ²", "İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ", "éa å",
             "x y z", "<|endoftext|> a<|startoftext|>b", "１２３ x²½ ﬁx", "a\x1cb don't'll 's''t", "日本語 mixed 한국어",
             "naïve,*** !!! ...", "\U0001F600ok", "ß SS ẞ Œuvre œ", "µ ª º × ÷ Ö"]
    tokens, whole = TextTokens(PATH), Tokenizer.from_file(PATH)
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, tokens.encode(texts)):
            assert np.frombuffer(ids, tokens.kind).tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_other_tokenizers_encode_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens = TextTokens(path)
    assert not tokens.by_word
    assert np.frombuffer(tokens.encode(["Some text"])[0], tokens.kind).tolist() == Tokenizer.from_file(path).encode("Some text").ids


def test_round_trip(spark, awkward, nothing):
    whole = Tokenizer.from_file(PATH)
    docs = awkward.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).repartition(3)
    text, pieces, sequences = {r.doc_id: r.text or "" for r in docs.collect()}, defaultdict(list), defaultdict(list)
    for r in pack_documents(docs, PATH).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(text)
    for doc, t in text.items():
        ids = np.array(whole.encode(t, add_special_tokens=False).ids + [1], "<u4")
        assert b"".join(bytes(r.ids) for r in sorted(pieces[doc], key=lambda r: r.start)) == ids.tobytes()
        assert {r.doc_tokens for r in pieces[doc]} == {len(ids)}
    for spans in sequences.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at == 2048 or at & (at - 1) == 0
    digests = {(r.doc_id, r.start): r.ids_crc32 for r in packed_digests(docs).collect() if r.length == r.doc_tokens}
    for (doc, _), crc in digests.items():
        assert crc == zlib.crc32(np.array(whole.encode(text[doc], add_special_tokens=False).ids + [1], "<u4").tobytes())
    assert pack_documents(awkward, PATH).filter("start = 0").count() == awkward.count()
    assert pack_documents(nothing, PATH).count() == 0
