"""Operators 2, 4, 5, 6, 8, 9 and 10: round trips, brute force and held-out accuracy."""

import collections
import fractions
import hashlib
import random
import zlib
from bisect import bisect_left

import numpy as np
import pytest
import zstandard
from llm_helpers import PROSE, table, texts_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from winnow.llm import bpe, chat, fingerprint, mixing, quality, sharding, unigram


def sha(b):
    return hashlib.sha256(b).hexdigest()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(bpe.MODEL)


def encoded(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("leaf", [64, bpe.LEAF])
def test_bpe(spark, docs, odd, empty, tokenizer, leaf):
    for df in (docs, odd):
        want = sorted((str(r.doc_id), sha(np.array(encoded(tokenizer, r.text or ""), "<u4").tobytes()), sha((r.text or "").encode())) for r in df.collect())
        assert sorted((str(r.doc_id), r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df, leaf).collect()) == want
    assert bpe.digests(empty, leaf).collect() == []
    back = bpe.decode(bpe.encode(docs, leaf))
    assert texts_of(back) == texts_of(docs)


def test_joins_agree_with_the_whole(tokenizer):
    c, r = bpe.Codec(), random.Random(4)
    for _ in range(400):
        text = "".join(r.choice(["a", "b", " ", "  ", "\n", "'s", "'", "!!", "12", "the", "ing", "é", "日", "<|endoftext|>", "\t", "zz", "  \n "]) for _ in range(r.randint(0, 60)))
        assert c.concatenate([c.encode(x) for x in bpe.cuts(text, r.randint(1, 12))]) == encoded(tokenizer, text), text
    for text in ("abcdefgh" * 3000, "a" * 5000, " " * 3000, "x" + "\n" * 2000 + "y", "日本" * 1500):
        assert c.concatenate([c.encode(x) for x in bpe.cuts(text, 300)]) == encoded(tokenizer, text)


@settings(deadline=None, max_examples=200)
@given(st.text(st.sampled_from(list("<|/sINST>[]\\ _um.turnedp")), max_size=60))
def test_escapes(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text and not any(x in safe for x in chat.CONTROL)


#: Two megabytes with control strings, special tokens and letters of several languages.
LONG = "</s>[INST] some words <|endoftext|> und Wörter, 日本語 \\\n" * 40_000


def chat_brute(rows):
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn if turn is not None else -1, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort(key=lambda x: x[0])
        loss = "".join(t for _, r, t in turns if r == "assistant")
        chars = sum(len(chat.TURN + chat.SEP + chat.END) + len(chat.escape(r)) + len(chat.escape(t)) for _, r, t in turns)
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()), len(loss), sha(loss.encode()), chars)
    return out


def test_chat(spark):
    rows = table(spark, "conversations")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in chat.digests(chat.planted(rows)).collect()}
    want = chat_brute([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()] + [(-1, i, w, "</s>[INST] ok [/INST]") for i, w in enumerate(("user", "assistant"))])
    assert got == want


def test_chat_odd(spark):
    rows = [(4, 0, "assistant", LONG), (1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, "assistant", "a\\<|end|>\\\\"), (1, 2, "assistant", "a\\<|end|>\\\\"), (2, None, None, "x"), (3, 0, "assistant", "<|turn|>" * 3 + "\u0000é日"), (None, 0, "system", "s")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in chat.digests(df).collect()}
    assert got == chat_brute(rows)
    for r in chat.format_conversations(df).collect():
        assert len(r.formatted) == chat_brute(rows)[r.conv_id][4]
        assert len(r.ids) == len(r.loss_mask) and r.formatted.count(chat.TURN) == r.n_turns == r.ids.count(chat.FIRST_RESERVED)
    assert chat.digests(df.limit(0)).collect() == []


def sets_likeness(a, b):
    def multi(t):
        return {(x, n) for x, k in collections.Counter(fingerprint.paragraphs(t)).items() for n in range(k)}

    x, y = multi(a), multi(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_fingerprints(docs, odd, empty):
    texts = texts_of(docs)
    ids = sorted(texts)
    got = {r.doc_id: r for r in fingerprint.fingerprint_edits(docs).collect()}
    assert sorted(got) == ids
    for i, k in zip(ids, ids[1:] + ids[:1], strict=True):
        e = fingerprint.edited(texts[i], texts[k])
        assert got[i].edited_sha256 == sha(e.encode()) and got[i].n_chars == len(texts[i])
        assert got[i].near_edited == pytest.approx(sets_likeness(texts[i], e)) and got[i].near_next == pytest.approx(sets_likeness(texts[i], texts[k]))
    prints = collections.defaultdict(set)
    for i in ids:
        prints[texts[i]].add(got[i].fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and len({p for v in prints.values() for p in v}) == len(prints)
    rows = fingerprint.fingerprint_edits(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    order = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    want = collections.Counter((a.doc_id, sha(fingerprint.edited(a.text or "", b.text or "").encode())) for a, b in zip(order, order[1:] + order[:1], strict=True))
    assert collections.Counter((r.doc_id, r.edited_sha256) for r in rows) == want
    assert fingerprint.fingerprint_edits(empty).collect() == []
    one = fingerprint.fingerprint_edits(docs.limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_large_differences_peel():
    a = [" ".join(f"a{i}. Sentence {i} of some length here" for i in range(n)) for n in (50, 500, 3000)]
    b = [x.replace("a1", "b1") for x in a]
    assert fingerprint.likeness(a, b) == pytest.approx([sets_likeness(x, y) for x, y in zip(a, b, strict=True)])


@pytest.mark.parametrize("size", [0, 5, 300, 4000])
def test_peeled_digests_are_the_difference(size):
    """What comes out of subtracted sketches are the digests themselves: those of the pieces that only one text has, occurrence by occurrence."""
    r = random.Random(size)
    words = [f"word{r.randint(0, 500)}" for _ in range(size)]
    a = " ".join(words)
    b = " ".join(w for w in words if r.random() > 0.1) + " and more" * (size > 5)
    sets = [set(fingerprint.digests([t])[0].tolist()) for t in (a, b)]
    assert fingerprint.difference(a, b) == (sets[0] - sets[1], sets[1] - sets[0])
    assert fingerprint.difference(a, a) == (set(), set()) and fingerprint.difference(a, "") == (sets[0], set())


def test_fingerprints_are_read_back(docs):
    texts = [t for t in texts_of(docs).values()][:60] + ["", LONG]
    s = fingerprint.Sketched(texts)
    n, *tables = fingerprint.read(s.fingerprints())
    assert n.tolist() == s.n.tolist()
    assert all((x == y).all() for x, y in zip(tables, s.some(np.arange(len(texts)), fingerprint.FIRST_CELLS), strict=True))
    a, b = np.arange(len(texts) - 1), np.arange(len(texts) - 1) + 1
    assert (s.likeness(a, b, s.fingerprints()) == s.likeness(a, b)).all()


@pytest.mark.parametrize("word", ["house ", "der Wald ", "日本語の文", "a1b2"])
def test_pieces_in_any_language(word):
    r = random.Random(2)
    text = "".join(word[: r.randint(1, len(word))] + chr(97 + r.randint(0, 25)) for _ in range(3000))
    parts = fingerprint.paragraphs(text)
    assert "".join(parts) == text and max(map(len, parts)) <= fingerprint.PIECE and len(text) / 20 < len(parts) < len(text) / 4
    # an insertion changes the pieces around it and no others
    changed = fingerprint.paragraphs(text[:5000] + "!" + text[5000:])
    assert len(set(parts) - set(changed)) <= 2


def words_likeness(a, b):
    x, y = collections.Counter(a.split()), collections.Counter(b.split())
    return (x & y).total() / (x | y).total()


def test_likeness_does_not_depend_on_length():
    r = random.Random(8)
    text = " ".join(r.choice(["rain", "went", "over", "a", "green", "hill", "cut", "some", "seven", "that", "house."]) + str(i)[-1:] * (i % 3 == 0) for i in range(400))
    for n in (100, 256, 390, 590, 599, 1000, 1500):
        for longer in (n + 4, n + 20):
            a, b = text[:n], text[:longer]
            assert fingerprint.likeness([a], [b])[0] > words_likeness(a, b) - 0.35 * (n < 300) - 0.2, (n, longer)
    a, b = text[:700], text[800:900]
    e = fingerprint.edited(a, b)
    assert len(e) < 600 and fingerprint.likeness([a], [e])[0] == pytest.approx(words_likeness(a, e), abs=0.15)


def test_counts_of_a_very_long_text(spark):
    vocab = unigram.vocabulary()
    t = Tokenizer(models.Unigram([("<unk>", min(vocab.values())), *vocab.items()], unk_id=0, byte_fallback=False))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=unigram.MARK, prepend_scheme="always", split=True)
    assert unigram.token_counts(spark.createDataFrame([(1, LONG)], "doc_id long, text string")).first().n_tokens == len(t.encode(LONG).ids)


def test_counts(docs, odd, empty):
    vocab = unigram.vocabulary()
    t = Tokenizer(models.Unigram([("<unk>", min(vocab.values())), *vocab.items()], unk_id=0, byte_fallback=False))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=unigram.MARK, prepend_scheme="always", split=True)
    for df in (docs, odd):
        rows = unigram.token_counts(df).collect()
        want = collections.Counter((r.doc_id, len(t.encode(r.text or "").ids)) for r in df.collect())
        assert collections.Counter((r.doc_id, r.n_tokens) for r in rows) == want
    assert unigram.token_counts(empty).collect() == []
    # ties, unknowns, scores whose sums are not exact
    small = {"▁": -1.5, "a": -1.0, "b": -1.0, "ab": -2.0, "aba": -3.0, "▁a": -2.5, "c": -0.1, "cc": -0.2}
    for scores in (small, {k: v * 0.3 for k, v in small.items()}):
        t = Tokenizer(models.Unigram([("<unk>", 0.0), *scores.items()], unk_id=0, byte_fallback=False))
        t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=unigram.MARK, prepend_scheme="always", split=True)
        c, r = unigram.Counter(scores), random.Random(7)
        c.unknown = min([*scores.values(), 0.0]) - unigram.UNKNOWN_PENALTY
        for _ in range(2000):
            text = "".join(r.choice("abc \nx▁é") for _ in range(r.randint(0, 14)))
            assert c.text(text) == len(t.encode(text).ids), text


def test_pfair():
    r = random.Random(3)
    for _ in range(60):
        slots = {str(i): r.randint(1, r.choice([3, 40])) for i in range(r.randint(1, 12))}
        period, got = sum(slots.values()), collections.defaultdict(list)
        for t, (s, _, _) in zip(range(period), mixing.in_turn(slots), strict=False):
            got[s].append(t)
        assert sorted(x for v in got.values() for x in v) == list(range(period))
        for s, at in got.items():
            assert all(i * period // slots[s] <= t < -(-(i + 1) * period // slots[s]) for i, t in enumerate(at))
            assert all(abs(bisect_left(at, t) - t * slots[s] / period) < 1 for t in range(period + 1))


@pytest.mark.parametrize("weights", [{"hot": 10.0} | {str(i): 20 / 19 for i in range(19)}, {"hot": 1.0, "rare": 1e-4, "other": 0.3}])
def test_mix_keeps_to_the_target_weights(weights):
    blocks = {s: int(w / sum(weights.values()) * 20_000) for s, w in weights.items()}
    plan, total = mixing.schedule(blocks, weights), sum(map(fractions.Fraction, weights.values()))
    assert {s: len(p[1]) for s, p in plan.items()} == blocks
    assert sorted(t for p in plan.values() for t in p[1]) == list(range(sum(blocks.values())))
    for s, (phase, slot, _, _) in plan.items():
        at, share = [t for f, t in zip(phase, slot, strict=True) if f == 0], fractions.Fraction(weights[s]) / total
        # just before and after each of its blocks, the source is less than one block from its share
        assert len(at) > 0 and all(abs(i - t * share) < 1 and abs(i + 1 - (t + 1) * share) < 1 for i, t in enumerate(at))


def test_mix(docs, odd, empty):
    rows = mixing.mix(docs, block_rows=3).collect()
    assert len(rows) == docs.count() and len({r.position for r in rows}) == len(rows)
    blocks = {(r.source, r.block): r for r in rows}
    assert sorted(r.slot for r in blocks.values()) == list(range(len(blocks)))
    start = {}
    for r in blocks.values():
        start[r.phase] = min(start.get(r.phase, r.slot), r.slot)
    assert all(r.released <= r.slot - start[r.phase] < r.due for r in blocks.values())
    one = {r.doc_id: r.position for r in mixing.mix(docs, block_rows=3).collect()}
    assert one == {r.doc_id: r.position for r in rows}
    assert len({r.position for r in mixing.mix(odd).collect()}) == odd.count()
    assert mixing.mix(empty).collect() == []
    ordered = [r.doc_id for r in mixing.in_mix_order(docs, block_rows=3).collect()]
    assert ordered == [r.doc_id for r in sorted(rows, key=lambda r: r.position)]
    out = mixing.in_mix_order(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    with pytest.raises(ValueError, match="weight"):
        mixing.mix(docs, weights={"src0": 1.0})
    monkey = mixing.mix(docs, weights={f"src{i}": 1.0 + i for i in range(30)}, block_rows=1)
    assert monkey.count() == docs.count()


def test_blocks_grow_with_the_rows(docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCKS", 10)
    rows = mixing.mix(docs).collect()
    assert len({r.slot for r in rows}) <= 10 + len({r.source for r in rows}) and len({r.position for r in rows}) == docs.count()


def test_many_sources(spark):
    rows = mixing.mix(spark.range(3000).selectExpr("id doc_id", "concat('s', id % 1500) source"), block_rows=1).collect()
    assert sorted(r.position for r in rows) == list(range(3000))


def test_ranking_in_ranges(docs, monkeypatch):
    whole = {r.doc_id: r.source_rank for r in mixing.mix(docs).collect()}
    monkeypatch.setattr(mixing, "RANKED", 2)
    assert {r.doc_id: r.source_rank for r in mixing.mix(docs).collect()} == whole


def test_shards(docs, odd, empty):
    for df in (docs, odd):
        rows, texts = sharding.assign(df).collect(), df.collect()
        assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == collections.Counter((t.doc_id, len((t.text or "").encode()) + 16, zlib.crc32((t.text or "").encode())) for t in texts)
        by = collections.defaultdict(list)
        for r in rows:
            by[r.shard].append(r.slot)
            assert 0 <= r.shard < 40 and r.law == "bytes" and r.grown_shard is None
        assert all(sorted(v) == list(range(len(v))) for v in by.values())
    load = collections.Counter()
    for r in sharding.assign(docs, shards=4).collect():
        load[r.shard] += r["size"]
    assert max(load.values()) < 1.02 * min(load.values())
    assert sharding.assign(empty).collect() == []


def shards_brute(rows, slots, m):
    """(shard, place there) of (slot, doc_id, crc, size) rows under a map: slots in order, rows of a slot in order."""
    out, filled = {}, collections.Counter()
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0], rows[i][1] is not None, rows[i][1] or 0, rows[i][2:])):
        k = m.shard[rows[i][0]]
        out[i] = (k, filled[k])
        filled[k] += 1
    return collections.Counter((rows[i][1], *at) for i, at in out.items())


def test_shards_by_brute_force(spark, docs, odd):
    for df in (docs, odd):
        base = sharding.sized(df)
        m = sharding.make_map(base, 7, 256)
        rows = [(r.virtual_slot, r.doc_id, r.text_crc32, r["size"]) for r in sharding.slotted(base, m.spread, 256).collect()]
        # the heaviest slot first, each to what is then the lightest shard
        weight = collections.Counter()
        for slot, _, _, n in rows:
            weight[slot] += n
        loads, count, where = [0] * 7, [0] * 7, {}
        for slot in sorted(range(256), key=lambda x: (-weight[x], x)):
            k = min(range(7), key=lambda k: (loads[k], count[k], k))
            where[slot], loads[k], count[k] = k, loads[k] + weight[slot], count[k] + 1
        assert m.shard == [where[x] for x in range(256)]
        assert collections.Counter((r.doc_id, r.shard, r.slot) for r in sharding.assign(df, 7, 256).collect()) == shards_brute(rows, 256, m)


def test_a_given_map(spark, docs, tmp_path):
    """A map made from some rows serves all: rows stay where it puts them, and places have no gaps."""
    some = docs.where("doc_id % 3 = 0")
    early = {(r.doc_id, r.virtual_slot): r.shard for r in sharding.assign(some, 5, 64, store=str(tmp_path / "map")).collect()}
    m = sharding.read_map(spark, str(tmp_path / "map"), 1)
    rows = sharding.assign(docs, slot_map=m).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(rows) == docs.count()
    assert all((r.shard == early[r.doc_id, r.virtual_slot]) for r in rows if r.doc_id % 3 == 0)
    # more rows and more shards leave slots alone; a text that has become heavy is dealt over slots by an edit of the map
    copies = docs.unionByName(spark.range(1000, 3000).selectExpr("id doc_id", "'copy of a text' text", "'en' lang", "'s' source", "14L n_chars"))
    base, grown = sharding.sized(copies), sharding.grow(m)
    heavy = sharding.heavy_texts(base, 6)
    assert len(heavy) == 1 and not m.spread
    before = {r.doc_id: r.virtual_slot for r in sharding.slotted(base, grown.spread, 64).collect()}
    edited = sharding.spread_more(grown, heavy)
    after = {r.doc_id: r.virtual_slot for r in sharding.slotted(base, edited.spread, 64).collect()}
    assert all(after[i] == before[i] for i in after if i < 1000) and len({after[i] for i in range(1000, 3000)}) > 5 and edited.version == 3


def test_slot_maps(spark, docs, tmp_path):
    rows = sharding.slotted(sharding.sized(docs), {}, 512)
    size, n = sharding.weigh(rows, 512)
    one = sharding.new_map(size, n, 8, {-5: 3})
    two = sharding.grow(one)
    moved = [s for s in range(512) if one.shard[s] != two.shard[s]]
    assert moved and all(two.shard[s] == 8 for s in moved) and two.version == 2
    assert max(two.loads()) < 1.2 * min(two.loads())
    heavier = [x * (3 if s % 50 == 0 else 1) for s, x in enumerate(size)]
    three = sharding.rebalance(two, heavier, n, tolerance=0.05)
    assert max(three.loads()) <= 1.1 * sum(heavier) / 9 and sum(a != b for a, b in zip(two.shard, three.shard, strict=True)) < 100
    for m in (one, two):
        sharding.write_map(spark, m, str(tmp_path / "map"))
    back = sharding.read_map(spark, str(tmp_path / "map"), 2)
    assert (back.shard, back.size, back.rows, back.spread) == (two.shard, two.size, two.rows, {-5: 3})
    with pytest.raises(Exception, match="already exists"):
        sharding.write_map(spark, one, str(tmp_path / "map"))


def test_hot_text_is_dealt_over_slots(spark):
    rows = [(i, PROSE) for i in range(300)] + [(1000 + i, f"text {i}") for i in range(600)]
    load = collections.Counter()
    for r in sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), shards=10).collect():
        load[r.shard] += r["size"]
    assert max(load.values()) < 1.1 * min(load.values())


def test_very_many_empty_texts_are_dealt_over_slots(spark):
    rows = [(i, "" if i % 2 else None) for i in range(500)] + [(1000 + i, f"text {i} " * 200) for i in range(600)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), shards=10).collect()
    assert max(collections.Counter(r.virtual_slot for r in got).values()) < 25 and len({(r.shard, r.slot) for r in got}) == 1100


def test_quality(spark, odd, empty):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    held = [(r.quality, got[r.doc_id].predicted) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert np.mean([q == p for q, p in held]) > 0.93
    rows = quality.score(odd, model).collect()
    assert len(rows) == odd.count() and not any(np.isnan(r.score) for r in rows) and len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert quality.score(empty, model).collect() == [] and quality.keep_good(odd, model).columns == odd.columns
    assert quality.score(odd, quality.fit(empty, labels.limit(0))).where("score <> 0.5").isEmpty()
    # every score by hand
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    plain, good, bad = (zstandard.ZstdCompressor(dict_data=d and zstandard.ZstdCompressionDict(d), compression_params=zstandard.ZstdCompressionParameters.from_level(quality.LEVEL, dict_size=len(d) if d else 0, window_log=quality.WINDOW_LOG, write_content_size=0, write_checksum=0, write_dict_id=0)) for d in (None, model.good, model.bad))
    for i, text in texts.items():
        raw = text.encode()
        k = max(1, -(-len(raw) // quality.PIECE))
        parts = [raw[len(raw) * j // k : len(raw) * (j + 1) // k] for j in range(k)]
        p, g, b = (sum(len(c.compress(x)) for x in parts) / k for c in (plain, good, bad))
        per = len(raw) / k + quality.SOFTEN
        z = model.weights[0] + sum(w * (x - m) / s for w, x, m, s in zip(model.weights[1:], ((b - g) / per, p / per), model.mean, model.scale, strict=True))
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), abs=1e-9)
    # repeated rows count once
    assert quality.fit(docs.union(docs.where("doc_id < 300")), labels).weights.tolist() == model.weights.tolist()
    # what is held out, and the other columns, change nothing
    changed = docs.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 'x', text) text", "'q' lang", "'s' source")
    assert quality.fit(changed, labels).weights.tolist() == model.weights.tolist()


def test_long_texts_keep_their_class(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = quality.fit(docs, labels)
    found = docs.join(labels.select("doc_id", "quality"), "doc_id").where("crc32(cast(doc_id as string)) % 3 = 1 and length(text) > 300").orderBy("doc_id").collect()
    for q in (0, 1):
        texts = [r.text for r in found if r.quality == q][:30]
        base = ["\n".join(texts[i : i + 6]) for i in range(0, len(texts), 6)]
        own = model.score(quality.measured(base, model.compressors()))
        long = model.score(quality.measured([t * (3_000_000 // len(t.encode()) + 1) for t in base] + ["\n".join(texts * 200)[:3_000_000]], model.compressors()))
        assert ((own >= 0.5) == q).all() and ((long >= 0.5) == q).all()
    # what stands late in a text counts like what stands early
    bad, good = ("\n".join([r.text for r in found if r.quality == q] * 200)[:2_000_000] for q in (0, 1))
    first, last = model.score(quality.measured([good + bad, bad + good], model.compressors()))
    assert first == pytest.approx(last, abs=0.05)
