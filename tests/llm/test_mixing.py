from __future__ import annotations

import math
from collections import Counter, defaultdict

from tests.llm.helpers import ODD, documents
from voltatlas.llm import mixing


def corpus(sizes: dict, words: int = 20) -> list[tuple]:
    rows, n = [], 0
    for source, count in sizes.items():
        for k in range(count):
            rows.append((n, " ".join(["w"] * (words + k % 7)), "en", source))
            n += 1
    return rows


def epochs(found) -> dict:
    out = defaultdict(lambda: defaultdict(set))
    for row in found:
        out[row.source][row.epoch].add(row.doc_id)
    return out


def tokens(rows: list[tuple]) -> Counter:
    out = Counter()
    for _, text, _, source in rows:
        out[source] += len((text or "").split())
    return out


def test_repetition_limit(spark):
    rows = corpus({"big": 900, "mid": 100, "tiny": 30})
    found = mixing.mix(documents(spark, rows), most_repeats=3.0).collect()
    total = tokens(rows)
    spread = max(total.values()) / min(total.values())
    point = 1 - math.log(3) / math.log(spread)  # where the smallest source is passed three times
    weight = {s: (n / sum(total.values())) ** point for s, n in total.items()}
    unit = total["big"] / weight["big"]
    seen = epochs(found)
    passed = Counter()
    for row in found:
        passed[row.source] += row.n_tokens
    for source in total:
        goal = weight[source] * unit
        assert goal - 200 <= passed[source] <= goal + 1e-3 * goal, source
        assert seen[source][0] == {r[0] for r in rows if r[3] == source}  # whole first epoch
        share = {row.weight for row in found if row.source == source}
        assert abs(share.pop() - weight[source] / sum(weight.values())) < 1e-4 and not share
    assert max(row.epoch for row in found) <= 3


def test_target_entropy(spark):
    rows = corpus({"big": 900, "mid": 100, "tiny": 30})
    found = mixing.mix(documents(spark, rows), target_entropy=0.6, most_repeats=50.0).collect()
    weight = {row.source: row.weight for row in found}
    entropy = -sum(w * math.log(w) for w in weight.values()) / math.log(len(weight))
    assert abs(sum(weight.values()) - 1) < 1e-9 and abs(entropy - 0.6) < 1e-4


def test_budget(spark):
    rows = corpus({"a": 200, "b": 100})
    total = sum(tokens(rows).values())
    found = mixing.mix(documents(spark, rows), budget=total // 4).collect()
    passed = sum(row.n_tokens for row in found)
    assert total // 4 - 60 <= passed <= total // 4
    assert Counter((row.doc_id, row.epoch) for row in found).most_common(1)[0][1] == 1
    # An epoch ends at a turn: what is passed comes before what is not, up to one block.
    for source in "ab":
        own = [row for row in found if row.source == source]
        whole = mixing.mix(documents(spark, [r for r in rows if r[3] == source])).collect()
        assert max(row.turn for row in own) <= max(row.turn for row in whole)


def test_epochs_run_through_blocks_in_other_orders(spark):
    found = mixing.mix(documents(spark, corpus({"a": 400, "b": 100})), most_repeats=2.0).collect()
    turns = defaultdict(dict)
    for row in found:
        if row.source == "b":
            turns[row.epoch][row.doc_id] = row.turn
    both = set(turns[0]) & set(turns.get(1, {}))
    one, two = (sorted(both, key=lambda d: (turns[e][d], d)) for e in (0, 1))
    assert len(both) > 50 and one != two


def test_rows(spark):
    found = mixing.mix(documents(spark, ODD)).collect()
    ids = Counter(row.doc_id for row in found if row.epoch == 0)
    assert ids == Counter(row[0] for row in ODD)  # nothing is left out, repeated rows stay together
    assert mixing.mix(documents(spark, [])).collect() == []
    empty = mixing.mix(documents(spark, [(1, "", "en", "a"), (2, None, "en", "b")])).collect()
    assert [(row.epoch, row.n_tokens) for row in empty] == [(0, 0), (0, 0)]
    assert mixing.mixed_documents(documents(spark, ODD)).columns == ["doc_id", "text", "lang", "source", "n_chars"]
