from __future__ import annotations

import hashlib
from collections import defaultdict

from corpus_cases import documents, prose  # noqa: F401
from pyspark.sql import functions as F

from statewise.llm.mixing import PACKET, mix, mix_schedule, source_targets


def waterfall(sizes, weights=(1, 2, 3), most=3):
    """Reshare the excess until no target is above, as the contract says."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, full = sum(sizes.values()), set()
    while True:
        rest = budget - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = sum(weight[s] for s in open_)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / share for s in names}
        above = {s for s in open_ if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def table(documents, prose):
    data = [(i, prose(i, 20 + i % 37), f"s{i % 4}") for i in range(200)]
    data += [(300, prose(300, 900), "tiny"), (301, prose(1, 2), "S"), (302, None, "void"), (303, "", None)]
    data += [(304, prose(304, 30), None), (304, prose(304, 30), None), (None, prose(5, 12), "s0")]
    return data, documents(data)


def test_targets_and_taken(documents, prose):
    data, frame = table(documents, prose)
    sizes = {}
    for _, text, source in data:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    expected = waterfall(sizes)
    found = mix(frame).collect()
    assert len(found) == len(data)
    taken = dict.fromkeys(sizes, 0)
    source_of = {i: s for i, _, s in data}
    for row in found:
        source = source_of[row.doc_id]
        assert row.source_size == sizes[source]
        assert abs(row.target - expected[source]) < 1e-6
        assert 0 <= row.taken <= 3 * row.size
        taken[source] += row.taken
    for source, words in taken.items():
        assert abs(words - expected[source]) <= PACKET
    assert sum(taken.values()) == sum(sizes.values())


def plain_queueing(queue, budget):
    """taken per row, by serving whole queues packet by packet in order of finish times."""
    rank = {s: i for i, s in enumerate(sorted({r.source for r in queue}, key=lambda s: (s is None, s)))}
    packets = []
    for source, place in rank.items():
        own = [r for r in queue if r.source == source]
        own.sort(key=lambda r: (hashlib.md5(f"mix{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest(), r.row))
        passed = 0
        for copy in range(3):
            for r in own:
                for begin in range(0, r.size, PACKET):
                    words = min(PACKET, r.size - begin)
                    passed += words
                    packets.append((passed / (place % 3 + 1), place, passed, r.row, words))
    taken = defaultdict(int)
    for _, _, _, row, words in sorted(packets):
        taken[row] += min(words, budget)
        budget -= min(words, budget)
    return taken


def test_equals_serving_the_queues_one_packet_at_a_time(documents, prose):
    _, frame = table(documents, prose)
    for budget in (None, 1234):
        queue, schedule = mix_schedule(frame, budget=budget)
        rows = queue.collect()
        expected = plain_queueing(rows, budget or sum(r.size for r in rows))
        found = {r.row: r.taken for r in schedule.groupBy("row").agg(F.sum("words").alias("taken")).collect()}
        assert found == {row: words for row, words in expected.items() if words}


def test_reruns_and_row_order_agree(documents, prose):
    _, frame = table(documents, prose)
    first = sorted(map(tuple, mix(frame).collect()), key=str)
    assert first == sorted(map(tuple, mix(frame.repartition(7)).collect()), key=str)


def test_the_schedule_is_in_order_of_finish_times(documents, prose):
    _, frame = table(documents, prose)
    queue, schedule = mix_schedule(frame)
    served = schedule.orderBy("mix_end").collect()
    assert [r.finish for r in served] == sorted(r.finish for r in served)
    assert served[-1].mix_end == sum(r.words for r in served)
    sizes = {r.row: r.size for r in queue.collect()}
    words = defaultdict(int)
    for r in served:
        assert r.begin == words[r.row, r.copy]
        words[r.row, r.copy] += r.words
    cut_short = [key for key, n in words.items() if n < sizes[key[0]]]
    assert len(cut_short) <= queue.select("source").distinct().count()


def test_a_smaller_budget(documents, prose):
    _, frame = table(documents, prose)
    queue, schedule = mix_schedule(frame, budget=500)
    assert schedule.agg({"words": "sum"}).first()[0] == 500
    targets, budget = source_targets(queue, budget=500)
    assert budget == 500 and abs(targets.agg({"target": "sum"}).first()[0] - 500) < 1e-6


def test_nothing_to_mix(documents):
    assert mix(documents([])).count() == 0
    assert [tuple(r) for r in mix(documents([(1, "", "a"), (2, None, None)])).orderBy("doc_id").collect()] == [
        (1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0),
    ]
