import collections
import math

import pytest

from cellweave.llm import mixture

DOC = "doc_id long, source string, n_tokens long, block int"
TARGET = "mix_name string, source string, target_weight double, max_repeats int, share int"
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


def docs(spark, sizes):
    """sizes: source to list of token counts."""
    made, i = [], 0
    for source, tokens in sizes.items():
        for n in tokens:
            made.append((i, source, n, 1))
            i += 1
    return spark.createDataFrame(made, DOC).repartition(3)


def targets(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], TARGET)


SIZES = {"big": [700] * 400, " BIG": [0, 3], "Mid ": [90, 110] * 60, "small": [50] * 40, None: [99], "": [5]}
ROWS = [("m", "big", 5.0, 3), ("m", "MID", 3.0, 4), ("m", "small", 2.0, 8), ("m", "gone", 4.0, 2), ("m", "mid", 0.0, None), ("n", "gone", 1.0, 2), (None, "big", 1.0, 1), ("o", "small", math.nan, 1), ("o", "big", None, 1), ("p", "small", 1.0, 0), ("p", "mid", 1.0, None)]


@pytest.fixture(scope="module")
def shares(spark):
    found = mixture.mixture_shares(docs(spark, SIZES), targets(spark, ROWS), block_tokens=32)
    return {(r.mix_name, r.source): r for r in found.collect()}


def test_shares_and_caps(shares):
    for source, share in (("big", 0.5), ("mid", 0.3), ("small", 0.2)):
        r = shares["m", source]
        assert abs(r.actual_share - share) < 0.01
        assert r.repeats_used <= r.max_repeats
    assert shares["m", "gone"].used_tokens == 0 and shares["m", "gone"].target_share == pytest.approx(4 / 14, abs=1e-6)
    assert max(shares["m", s].used_tokens / (shares["m", s].available_tokens * shares["m", s].max_repeats) for s in ("big", "mid", "small")) > 0.95
    assert shares["n", "gone"].used_tokens == 0 and shares["o", "small"].used_tokens == 0
    assert shares["p", "small"].used_tokens == 0 and shares["p", "mid"].actual_share == 1.0


def test_blocks_hold_every_token_once(spark):
    sized = docs(spark, SIZES).where("source = 'big'").select("doc_id", "source", "n_tokens")
    segments = mixture._segments(sized, 32, 1).collect()
    per_doc, per_block = collections.defaultdict(list), collections.Counter()
    for s in segments:
        per_doc[s.doc_id].append((s.token_from, s.token_to))
        per_block[s.block] += s.token_to - s.token_from
    assert len(per_doc) == 400
    for parts in per_doc.values():
        parts.sort()
        assert parts[0][0] == 0 and parts[-1][1] == 700 and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
    assert set(list(per_block.values())[:-1]) <= {32} and sorted(per_block) == list(range(len(per_block)))


def test_slots_are_spread(spark):
    found = mixture.mixture(docs(spark, SIZES), targets(spark, ROWS), block_tokens=32).where("mix_name = 'm'")
    slots = dict(found.select("slot", "source").distinct().collect())
    order = [slots[i] for i in sorted(slots)]
    for start in range(0, len(order) - 100, 50):
        window = collections.Counter(order[start : start + 100])
        assert abs(window["big"] - 50) <= 5 and abs(window["mid"] - 30) <= 5 and abs(window["small"] - 20) <= 5
    uses = found.select("source", "repeat_no", "slot").distinct().groupBy("source").agg({"repeat_no": "max"}).collect()
    assert dict(uses) and all(n <= {"big": 3, "mid": 4, "small": 8}[s] for s, n in uses)


def test_no_slot_is_left_out(spark, monkeypatch):
    for bits in (16, 3):
        monkeypatch.setattr(mixture, "CHUNK_BITS", bits)
        tight = [("m", "big", 1.0, 1), ("m", "mid", 1.0, 1), ("m", "small", 1.0, 1), ("q", "small", 1.0, 1), ("q", "mid", 7.3, 1)]
        slots = mixture.mixture(docs(spark, SIZES), targets(spark, tight), block_tokens=32).select("mix_name", "slot", "source").distinct().collect()
        for mix in "mq":
            mine = sorted((r.slot, r.source) for r in slots if r.mix_name == mix)
            assert [n for n, _ in mine] == list(range(len(mine))) and mine
        used = collections.Counter(r.source for r in slots if r.mix_name == "m")
        small = math.ceil(50 * 40 / 32)
        assert used["small"] <= small and max(used.values()) - min(used.values()) <= 4 and used["small"] >= small - 4


def test_the_same_on_every_run(spark):
    a, b = (mixture.mixture(docs(spark, SIZES).repartition(n), targets(spark, ROWS), 32).collect() for n in (1, 5))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_chunks_do_not_change_ranks(spark, monkeypatch):
    a = sorted(map(tuple, mixture.mixture(docs(spark, SIZES), targets(spark, ROWS), 32).select("slot", "source", "repeat_no").distinct().collect()))
    monkeypatch.setattr(mixture, "CHUNK_BITS", 4)
    monkeypatch.setattr(mixture, "BUCKET_DOCS", 7)
    b = sorted(map(tuple, mixture.mixture(docs(spark, SIZES), targets(spark, ROWS), 32).select("slot", "source", "repeat_no").distinct().collect()))
    assert a == b


def test_token_counts(spark):
    long = "ab cd " * 100_000
    rows = [(1, "a", "Hello, wörld! <|endoftext|>"), (2, None, None), (3, "b", ""), (4, "b", long)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r.n_tokens for r in mixture.token_counts(df, RANKS).collect()}
    assert got[2] == got[3] == 0 and got[1] > 5 and got[4] > 100_000


def test_empty(spark):
    assert mixture.mixture(docs(spark, {}), targets(spark, ROWS), 32).count() == 0
    assert mixture.mixture(docs(spark, SIZES), targets(spark, []), 32).count() == 0
