"""Token ids, files and packing: exact round trips and plain loops."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from turnstile.llm import packing, token_files, tokens
from turnstile.llm.common import shared_folder, tokenizer_file

PATH = tokenizer_file("byte_bpe_50k.json")
LONG = "héllo wörld, it's 123!! " * 4000
ROWS = [(5, "one two"), (3, None), (1, ""), (None, "lost id"), (9, LONG), (7, " \n\t x  y\n"), (5, "one two"), (8, "<|endoftext|> a"),
        (4, "the. end,of it")]


def plain(text, end):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, end]


def test_stretches_give_the_ids_of_whole_texts():
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "'s", "'", "!!", "1", "23", "日本", "\xa0", "word", ".", ",", "*", "_", "😀",
             "\x85", "<|endoftext|>", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    usual = [p for p in parts if p not in ("\t", "\r\n", "\xa0", "\x85", "<|endoftext|>")]
    texts += ["".join(rng.choice(usual) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    whole = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, tokens.encode(texts, PATH, 7), strict=True):
        assert ids.tolist() == [*whole.encode(text, add_special_tokens=False).ids, 7], text
    other = tokenizer_file("word_bpe_49k.json")  # works on whole texts
    assert [x.tolist() for x in tokens.encode(["A b."], other, 1)] == [
        [*Tokenizer.from_file(other).encode("A b.", add_special_tokens=False).ids, 1]
    ]


class Counting:
    """A tokenizer that counts the texts it is given at once."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.given += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_new_stretches_are_encoded_together_and_once(monkeypatch):
    monkeypatch.setattr(tokens, "_REMEMBERED", 40)
    memory = tokens._Memory(PATH)
    memory.tokenizer = counting = Counting(memory.tokenizer)
    whole = Tokenizer.from_file(PATH)
    usual = " ".join(f"café{k}" for k in range(30))
    for n in range(20):  # 20 new words a text, so the memory is renewed every other text or two
        text = f"{usual}\n\n" + " ".join(f"wörd{n}x{k}" for k in range(20)) + f". {usual}"
        (ids,) = memory.encode([text])
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    given = "".join(counting.given)
    assert len(counting.given) <= 20 + 3  # one text of new stretches a call; the first word and the sign by themselves
    assert given.count("café29") == 1 and given.count("wörd7x7") == 1


def test_stretches_that_only_together_make_a_special_string(tmp_path):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.add_special_tokens(["x y"])
    tokenizer.save(path := str(tmp_path / "t.json"))
    texts = ["a x", "b y", "c x y d", " é z"]
    for text, ids in zip(texts, tokens.encode(texts, path, 7), strict=True):
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 7]


def test_dictionary_sample_has_one_row_an_id(spark, docs_of, monkeypatch):
    samples = []
    monkeypatch.setattr(token_files, "train_dictionary", lambda s: samples.append(len(s)) or b"")
    token_files.write_tokens(docs_of([(1, "a b")] * 30 + [(1, "c"), (2, "d"), (None, "e")]), shared_folder(spark), PATH)
    assert samples == [2]


@pytest.mark.parametrize("per_shard", [2, 1000])
def test_round_trip(spark, docs_of, per_shard):
    folder = shared_folder(spark)
    written = token_files.write_tokens(docs_of(ROWS), folder, PATH, documents_per_shard=per_shard)
    back = token_files.read_tokens(written, folder).collect()
    back.sort(key=lambda r: r.start)
    texts = defaultdict(list)
    for i, t in ROWS:
        texts[i].append(t)
    assert [r.doc_id for r in back] == [None, 1, 3, 4, 5, 5, 7, 8, 9]
    start = 0
    for r in back:
        ids = plain(texts[r.doc_id][0], 0)
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        start += len(ids)
    # One document alone, and a wrong dictionary.
    local, path = token_files.open_folder(folder)
    dictionary = local.open_input_stream(f"{path}/dictionary").read()
    for row in written.collect():
        file = local.open_input_file(f"{path}/{row.file}")
        shard = token_files.Shard(file, dictionary)
        for k in shard.find(7):
            assert shard[k].tolist() == plain(texts[7][0], 0)
        with pytest.raises(ValueError, match="another dictionary"):
            token_files.Shard(file, dictionary + b"x")


def test_empty_table(spark, docs_of):
    assert token_files.round_trip(docs_of([]), PATH).count() == 0
    assert packing.pack(docs_of([]), PATH).count() == 0


def test_dictionary_shrinks_short_documents(tmp_path):
    rng = random.Random(2)
    words = [[rng.randrange(50_000) for _ in range(4)] for _ in range(300)]
    docs = [np.array([t for _ in range(30) for t in rng.choice(words)], np.uint32) for _ in range(600)]
    sizes = []
    for dictionary in (b"", token_files.train_dictionary([d.astype("<u2").tobytes() for d in docs[:400]])):
        file = str(tmp_path / f"s{len(sizes)}")
        with fs.LocalFileSystem().open_output_stream(file) as out:
            writer = token_files.ShardWriter(out, "<u2", dictionary)
            for k, d in enumerate(docs):
                writer.add(k, d)
            writer.finish()
            sizes.append(writer.at)
        shard = token_files.Shard(fs.LocalFileSystem().open_input_file(file), dictionary)
        assert all((shard[k] == d).all() for k, d in enumerate(docs))
    assert sizes[1] < 0.7 * sizes[0]


def test_packing(docs_of):
    rows = ROWS + [(100 + k, "word " * random.Random(k).randint(0, 900)) for k in range(60)]
    found = packing.pack(docs_of(rows), PATH, end_id=2, capacity=256).collect()
    fill, pieces = defaultdict(list), defaultdict(list)
    for r in found:
        fill[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
        assert r.length <= 256 and len(r.ids) == 4 * r.length
    for places in fill.values():  # gapless
        assert sum(n for _, n in places) <= 256
        assert sorted(places) == [(sum(n for _, n in sorted(places)[:k]), sorted(places)[k][1]) for k in range(len(places))]
    times = Counter(i for i, _ in rows)
    for i, t in rows:
        ids = plain(t, 2)
        own = sorted(pieces[i], key=lambda r: r.piece)[:: times[i]]
        assert [r.piece for r in own] == list(range(len(own)))
        assert b"".join(r.ids for r in own) == np.array(ids, "<u4").tobytes()
        assert all(r.length == 256 for r in own[1:])
        assert [zlib.crc32(r.ids) for r in own] and own[0].start == 0
    total = sum(r.length for r in found)
    assert len(fill) <= math.ceil(total / 256) * 1.1 + 1


def simulated(counts, capacity):
    """Piece by piece, searching every pair."""
    left, bins = list(counts), []
    while any(left):
        content, gap = [], capacity
        while fit := next((n for n in range(gap, 0, -1) if left[n]), 0):
            content.append(fit)
            left[fit] -= 1
            gap -= fit
        if gap and len(content) > 1:
            smallest = content[-1]
            pairs = [
                (a + b, a, b)
                for a in range(1, gap + smallest)
                for b in range(1, a + 1)
                if smallest < a + b <= gap + smallest and left[a] and left[b] > (a == b)
            ]
            if pairs:
                _, a, b = max(pairs)
                left[content.pop()] += 1
                left[a] -= 1
                left[b] -= 1
                content += [a, b]
        bins.append(content)
    return bins


def test_plan_equals_packing_one_by_one():
    rng = random.Random(3)
    for _ in range(200):
        capacity = rng.choice([5, 10, 20, 30])
        counts = [0] + [rng.choice([0, 0, 1, 2, 7]) for _ in range(capacity)]
        plan = packing.best_two_fit(counts, capacity)
        used = Counter()
        for lengths, times in plan:
            assert sum(lengths) <= capacity
            for n in lengths:
                used[n] += times
        assert all(used[n] == c for n, c in enumerate(counts))
        assert sum(times for _, times in plan) == len(simulated(counts, capacity))
    assert packing.best_two_fit([0] * 11, 10) == []
