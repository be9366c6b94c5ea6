"""BPE round trip, token counts and packing against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fleetwatt.llm import bpe, packing, token_counts
from tests.llm.texts import clashing, corpus, frame

MODEL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return MODEL.encode(text or "", add_special_tokens=False).ids


def test_round_trip(spark):
    out = bpe.encode_decode(clashing(spark).drop("n_tokens"))
    assert out.columns[-2:] == ["token_ids", "decoded"] and "lead" in out.columns
    rows = out.collect()
    assert len(rows) == len(corpus())
    for r in rows:
        ids = ids_of(r.text)
        assert np.frombuffer(r.token_ids, "<u4").tolist() == ids
        assert r.decoded == MODEL.decode(ids, skip_special_tokens=False)


def test_round_trip_of_no_rows(spark):
    assert bpe.encode_decode(frame(spark, [])).collect() == []


@pytest.mark.parametrize("letters", ["thean", "Ãâ", "-=_.", "abcdefghijklmnopqrstuvwxyz", " \n\t", "a"])
def test_windows_give_what_the_whole_gives(letters):
    rnd = random.Random(letters)
    model = bpe.byte_bpe(bpe.VOCABULARY)
    text = "".join(rnd.choice(letters) for _ in range(12_000))
    assert model.merges.window < 12_000 and model.merges.lookahead < model.merges.window // 2
    assert np.frombuffer(b"".join(model.encode_stream(text)), "<u4").tolist() == ids_of(text)


def test_every_character():
    model = bpe.byte_bpe(bpe.VOCABULARY)
    points = [c for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 500):
        text = " a".join(map(chr, points[i : i + 500]))
        assert np.frombuffer(b"".join(model.encode_stream(text)), "<u4").tolist() == ids_of(text)


def test_decoding_waits_for_whole_characters():
    model = bpe.byte_bpe(bpe.VOCABULARY)
    ids = ids_of("é😀 中文 naïve")
    one_by_one = [np.array([i], "<u4").tobytes() for i in ids]
    assert "".join(model.decode_stream(one_by_one)) == "é😀 中文 naïve"
    broken = np.array([i for i in range(128, 200)], "<u4").tobytes()
    assert "".join(model.decode_stream([broken])) == MODEL.decode(list(range(128, 200)), skip_special_tokens=False)


@pytest.mark.parametrize("vocabulary", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts(spark, vocabulary):
    out = token_counts.token_counts(clashing(spark), limit=20, vocabulary=vocabulary)
    if vocabulary.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        count = lambda t: len(model.encode(t))
    else:
        model = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    rows = out.collect()
    assert len(rows) == len(corpus())
    for r in rows:
        text = r.text or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), count(text), count(text) > 20)


def test_long_texts_are_cut_where_nothing_changes():
    count = token_counts._counter(token_counts.VOCABULARY)
    rnd = random.Random(2)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "b ", " ", "▁", "é", "\n", ". c", "de f"]) for _ in range(80))
        assert sum(count(list(token_counts.parts(text, True, 10)))) == count([text])[0]


def brute_pieces(rows):
    out = []
    for doc, text, *_ in rows:
        ids = [*ids_of(text), 2]
        n = len(ids)
        cuts = [0, n] if n <= 1024 else [0, *range(n % 1024 or 1024, n + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def test_packing(spark):
    rows = packing.packed_documents(clashing(spark)).collect()
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(brute_pieces(corpus()), key=key)
    gapless(rows, 1024)
    again = packing.packed_documents(frame(spark).repartition(7)).collect()
    assert len({r.sequence_id for r in again}) == len({r.sequence_id for r in rows})


def gapless(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity


@pytest.mark.parametrize("cached", [500_000, 7])
def test_a_word_with_other_marks_is_not_encoded_again(cached, monkeypatch):
    """Words are encoded without their marks, many in one call; ids stay those of whole texts."""
    monkeypatch.setattr(packing, "CACHED_UNITS", cached)
    monkeypatch.setattr(packing, "CACHED_STEMS", cached, raising=False)
    rnd = random.Random(5)
    words = ["".join(rnd.choice("theanoré") for _ in range(1 + i % 9)) for i in range(40)]
    odd = ["a<|endoftext|>", "don't", "x's,", "a²,", "三,", "ÿ×", "9.", "_", "a_b.", "''", "e\u0301."]
    texts = [" ".join(w + m for w in [*words, *odd]) for m in ["", ",", ".", "$$$", "***", "&&&", "%%%", ".)", "'", "'s"]]
    model = packing._UnitIds("byte_bpe_50k.json")
    asked, real = [], model.model

    class Counted:
        def encode_batch_fast(self, batch, **options):
            asked.extend(batch)
            return real.encode_batch_fast(batch, **options)

    model.model = Counted()
    for text in [*texts, *texts]:
        assert np.frombuffer(model.ids([text])[0], "<u4").tolist() == ids_of(text)
    if cached > 7:
        assert len(asked) < 300 and sum(x.count(" ") for x in asked) < 400


def test_packing_of_no_rows(spark):
    assert packing.packed_documents(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_whole_and_near_the_bound(seed):
    rnd = random.Random(seed)
    counts = {rnd.randrange(1, 101): rnd.randrange(1, 400) for _ in range(rnd.choice([1, 3, 60]))}
    runs = packing.plan(counts, 100)
    for length, n in counts.items():
        ranks = sorted((r.first, r.count) for r in runs if r.length == length)
        assert sum(c for _, c in ranks) == n and all(a + c == b for (a, c), (b, _) in zip(ranks, ranks[1:]))
    fill, large = {}, {}
    for r in runs:
        for s in range(r.sequence, r.sequence + r.count):
            fill.setdefault(s, []).append((r.offset, r.length))
            large[s] = large.get(s, 0) + (3 * r.length > 100)
    for parts in fill.values():
        parts.sort()
        assert parts[0][0] == 0 and all(o + n == p for (o, n), (p, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= 100
    assert max(large.values()) <= 2
    singles = sorted([x for x, n in counts.items() for _ in range(n)], reverse=True)
    bins = []  # first-fit decreasing
    for x in singles:
        i = next((i for i, room in enumerate(bins) if room >= x), None)
        if i is None:
            bins.append(100 - x)
        else:
            bins[i] -= x
    assert len(fill) <= len(bins)


def test_queries(spark):
    from fleetwatt.llm.queries import QUERIES
    from tests.conftest import SF_DIR

    docs = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op1_bpe_round_trip"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = ids_of(docs[r.doc_id])
        text = MODEL.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        )
    packed = QUERIES["op5_best_fit_packing"](spark, SF_DIR).collect()
    assert sorted(tuple(r)[:5] for r in packed) == sorted(brute_pieces(docs.items()))
    gapless(packed, 1024)
    assert QUERIES["op10_token_counts"](spark, SF_DIR).count() == len(docs)


def test_workers_keep_no_words_of_a_finished_task(spark):
    """Idle workers live on into the next stage, whose executor must not hold their words too."""
    docs = frame(spark).repartition(4)
    assert packing.pieces(docs).count() > 0

    def held(batches):
        from fleetwatt.llm import packing as here

        model = here._unit_ids(here.VOCABULARY)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(model.spaced) + len(model.known) + len(model.stems)] * batch.num_rows, pa.int64())})

    assert spark.range(0, 8, 1, 4).mapInArrow(held, "n bigint").agg({"n": "max"}).first()[0] == 0
