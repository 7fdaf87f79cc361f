import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import SF, docs_of, frame
from tokenizers import Tokenizer

from chromasea.llm import idsfile, packing
from chromasea.llm.queries import QUERIES
from chromasea.llm.tokens import Encoder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def whole(path, text, end):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_whole_texts(path):
    r, library, own = random.Random(4), Tokenizer.from_file(path), Encoder(path)
    bits = ["a", "B", " ", "  ", "\n", "\t", "é", "é", "'s", "'ll", "1", "23", "!", "...", "　", "\xa0", "\x1c", "Σ", "<|endoftext|>", "ß", "😀", "-", "word", "\r\n"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(40))) for _ in range(2000)]
    for text, ids in zip(texts, own(texts)):
        assert library.encode(text, add_special_tokens=False).ids == ids.tolist(), repr(text)


def test_plain_words_are_learned_by_their_stems(monkeypatch):
    """Words of letters go to the model once, whatever marks end them, and aren't encoded as texts."""
    library, own = Tokenizer.from_file(BYTE), Encoder(BYTE)
    texts = ["Zorbleth zorbleth, zorbleth. zorbleth!? señor; Ñandú: ªº", "zorbleth\nzorbleth?!\n\nÿé,", f"a{'b' * 100}, a{'b' * 100}. {'!' * 100}"]
    asked = []
    monkeypatch.setattr(own, "_encoded", lambda words, f=own._encoded: asked.extend(words) or f(words))
    assert [library.encode(t, add_special_tokens=False).ids for t in texts] == [i.tolist() for i in own(texts)]
    assert set(asked) <= {"\n", f" {'!' * 100}"} and " zorbleth" in own.known
    mixed = ["it's, we'll. 12, x1; -y- (z), «q», Ωmega, 中文。 a_b:", "dž, ŉ, ﬁn; ¼, ²."]
    assert [library.encode(t, add_special_tokens=False).ids for t in mixed] == [i.tolist() for i in own(mixed)]


def expected_ids(rows, path, end):
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = whole(path, text, end)
        out.append((key, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_ids_query(spark):
    rows = [(r.doc_id, r.text) for r in docs_of(spark).collect()]
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op2_token_ids"](spark, SF).collect())
    assert got == expected_ids(rows, BYTE, 2)


def test_ids_of_awkward_texts(spark, awkward):
    shards, dictionary = idsfile.write_ids(frame(spark, awkward), BYTE)
    got = idsfile.read_ids(shards, dictionary, with_ids=True).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((k, n, c) for k, _, n, c in expected_ids(awkward, BYTE, 2))
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place and len(r.ids) == r.n_tokens
        place += r.n_tokens
    assert [r.doc_id or -1 for r in sorted(got, key=lambda r: r.start)] == sorted(r.doc_id or -1 for r in got)
    assert idsfile.read_document(spark, shards, dictionary, 4) == [whole(BYTE, "one two three", 2)]
    assert idsfile.read_document(spark, shards, dictionary, 10) == [whole(BYTE, "same text here", 2)] * 2
    assert idsfile.read_document(spark, shards, dictionary, 99) == []
    with pytest.raises(Exception, match="not a shard of this dictionary"):
        idsfile.read_ids(shards, dictionary + b"x").count()


def test_no_documents(spark):
    shards, dictionary = idsfile.write_ids(frame(spark, []), BYTE)
    assert dictionary == b"" and idsfile.read_ids(shards, dictionary).count() == 0
    assert packing.pack_documents(frame(spark, []), WORD).count() == 0


def check_packing(rows, docs, path, capacity):
    """Every token of every document once, in gapless sequences within the capacity."""
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    texts = defaultdict(list)
    for key, text in docs:
        texts[key].append(whole(path, text, 0))
    assert set(pieces) == set(texts)
    for key, wanted in texts.items():
        expect = Counter((n, s, len(ids[s : s + capacity]), crc(ids[s : s + capacity])) for ids in wanted for n, s in enumerate(range(0, len(ids), capacity)))
        assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in pieces[key]) == expect
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def best_fit(lengths, capacity):
    """One document at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_packing_query(spark):
    docs = [(r.doc_id, r.text) for r in docs_of(spark).collect()]
    rows = QUERIES["op3_best_fit_packing"](spark, SF).collect()
    assert check_packing(rows, docs, WORD, 2048) == best_fit([r.length for r in rows], 2048)


def test_packing_awkward_texts(spark, awkward):
    rows = packing.pack_documents(frame(spark, awkward), WORD, capacity=64).collect()
    check_packing(rows, awkward, WORD, 64)


def test_plan_equals_best_fit_by_document():
    r = random.Random(2)
    for _ in range(60):
        capacity = r.choice([7, 20, 64])
        lengths = [r.randrange(1, capacity + 1) for _ in range(r.randrange(1, 400))]
        plan = packing.plan_best_fit(dict(Counter(lengths)), capacity)
        assert plan.sequences == best_fit(lengths, capacity)
        seen, taken = Counter(), Counter()
        for n in lengths:
            sequence, offset = plan.place(np.array([n]), np.array([seen[n]]))
            seen[n] += 1
            for k in range(n):
                taken[int(sequence[0]), int(offset[0]) + k] += 1
        assert set(taken.values()) == {1} and max(o for _, o in taken) < capacity


def test_assembled_sequences(spark):
    docs = [(i, f"text number {i} of some") for i in range(40)]
    pieces = packing.materialise(packing.token_pieces(frame(spark, docs), WORD, 32, with_ids=True), "pieces")
    for s in packing.assemble(packing.pack(pieces, 32)).collect():
        wanted = [i for d in s.doc_ids for i in whole(WORD, docs[d][1], 0)]
        assert s.ids == wanted and len(s.ids) <= 32
