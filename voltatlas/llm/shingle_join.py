"""Jaccard join of 5-word shingle sets by token-combination prefixes.

Tokens are shingle hashes. Their order puts rare tokens first and frequent
ones last, by hash within a class. Two sets of similarity t share at least the
least t * n of their tokens, so their K least common tokens lie in the first
n - ceil(t n) + K of both.

* If all of these K are rare, the sets share K single-token keys of that
  prefix. K is a part of the set's size, so a set with fewer shared keys is
  done with, and of the others only the least shared keys need be looked at:
  a set that must share r of its m shared keys shares one of the m - r + 1 that
  come first in the order of how many sets hold them.
* Else fewer than K common tokens are rare, and of the B + K least common ones,
  in the prefix extended to n - ceil(t n) + B + K, more than B are frequent.
  Frequent tokens fall into B buckets by hash, so two of them share a bucket:
  combinations of two tokens within a bucket are the keys. B grows with the
  set's size, which keeps the number of combinations in proportion to it. As it
  must be the same on both sides, a set is indexed under its own size class and
  the one below.

Which tokens count as frequent changes the cost, never the result. Equal sets
are one node from the start. Sets are first compared with the hub they share
most keys with; only pairs that this leaves in different components are then
compared one by one, by sketches before the sets themselves.

Rows: a null or empty text has an empty set and links with nothing. Rows with
fewer than five words have one shingle. Equal ids and repeated rows are
single rows of the result each; a null id never names a component, unless
all ids of it are null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.llm.common import in_chunks, pick, stored
from voltatlas.llm.graph import components
from voltatlas.llm.wordhash import mix, shingles, words_of

SIZE = 5
#: Similarity from which two sets link, as a fraction.
OVER, UNDER = 3, 4
#: A token is frequent from this many sets on, or from this share of the sets if that is more;
#: so there are at most FREQUENT_SHARE times the mean set size of them, and they may be broadcast.
FREQUENT_SETS, FREQUENT_SHARE = 32, 10_000
#: Tokens looked at together to find frequent ones, and how often one must occur among them.
TOKENS_AT_ONCE, OFTEN = 2_000_000, 3
#: Sets with fewer tokens per bucket class than this share one bucket.
TOKENS_PER_BUCKET = 8
#: A set is indexed so that a link shows in one key for so many of its tokens.
TOKENS_PER_SHARED = 16
#: Bits of the filter that tells which documents a comparison needs; its size is fixed.
FILTER_BITS = 1 << 24


def least_common(n: int) -> int:
    """Tokens a set of n tokens shares at least with any it links to."""
    return -(-OVER * n // UNDER)


def signature(tokens: np.ndarray) -> int:
    """64 bits for a set, the same for equal sets."""
    total = np.add.reduce(mix(tokens + np.uint64(0x9E3779B97F4A7C15)), keepdims=True)
    return int(mix(total + np.uint64(len(tokens))).view(np.int64)[0])


def shared_singles(n: int) -> int:
    """Single keys that sets of at least n tokens share if they link, unless they share a combination."""
    return max(1, n // TOKENS_PER_SHARED)


def size_class(n: int) -> int:
    return max(n // TOKENS_PER_BUCKET, 1).bit_length() - 1


def combination_keys(frequent: np.ndarray, buckets: int, size: int) -> np.ndarray:
    """Keys of all pairs of tokens in one bucket."""
    bucket = mix(frequent ^ np.uint64(0x51ED270B)) % np.uint64(buckets)
    order = np.lexsort((frequent, bucket))
    token, bucket = frequent[order], bucket[order]
    found = []
    for step in range(1, len(token)):
        same = bucket[step:] == bucket[:-step]
        if not same.any():
            break
        found.append(mix(mix(token[:-step][same] + np.uint64(size)) * np.uint64(3) + token[step:][same]))
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def keys_of(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Single-token keys of rare tokens, and keys of combinations of frequent ones."""
    n = len(tokens)
    none = np.empty(0, dtype=np.uint64)
    if n <= 2:  # such a set links to equal sets only
        return none, none
    known = np.zeros(n, dtype=bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        known = frequent[at] == tokens
    rare, often = tokens[~known], tokens[known]
    spare = n - least_common(n) + shared_singles(n)
    combined = []
    own = size_class(n)
    for size in (own, own - 1):
        if size < 0 or size < own and OVER * n >= UNDER * (TOKENS_PER_BUCKET << own):
            continue  # no set of the class below is large enough
        buckets = 1 << size
        part = often[:max(0, spare + buckets - len(rare))]
        combined.append(combination_keys(part, buckets, size))
    return rare[:spare], np.concatenate(combined)


def sets_and_counts(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: doc_id, n and sig of each document; token and times of tokens that are frequent in a stretch."""
    rows = pick(docs, "doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(name, T.LongType())
                                                   for name in ("n", "sig", "token", "times"))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        total = 0

        def counted() -> pa.RecordBatch:
            token, times = np.unique(np.concatenate(list(held.values())), return_counts=True)
            token, times = token[times >= OFTEN].view(np.int64), times[times >= OFTEN]
            empty = pa.nulls(len(token), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(token), id_type), empty, empty, pa.array(token), pa.array(times)], schema.names)

        id_type = None
        for chunk in in_chunks(batches):
            id_type = chunk.schema.field(0).type
            found = shingles(words_of(chunk.column(1).to_pylist()), SIZE)
            sigs = [signature(tokens) if len(tokens) else None for tokens in found]
            empty = pa.nulls(len(found), pa.int64())
            yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array([len(tokens) for tokens in found], pa.int64()),
                                              pa.array(sigs, pa.int64()), empty, empty], schema.names)
            for sig, tokens in zip(sigs, found):
                if sig is not None and sig not in held:
                    held[sig] = tokens
                    total += len(tokens)
            if total >= TOKENS_AT_ONCE:
                yield counted()
                held, total = {}, 0
        if held:
            yield counted()

    return rows.mapInArrow(task, schema)


def frequent_tokens(counts: DataFrame, sets: int) -> np.ndarray:
    """Sorted hashes of the frequent tokens; the least count bounds how many there can be."""
    least = max(FREQUENT_SETS, -(-sets // FREQUENT_SHARE))
    found = counts.where("token is not null").groupBy("token").agg(F.sum("times").alias("times")).where(
        F.col("times") >= least).select("token").toPandas()["token"].to_numpy(np.int64)
    return np.sort(found.view(np.uint64))


def keys(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """key, sig, n, the numbers of single and of all keys of the set, and whether the key is a combination."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for chunk in in_chunks(batches):
            parts = []
            for tokens in shingles(words_of(chunk.column(0).to_pylist()), SIZE):
                sig = signature(tokens) if len(tokens) else None
                if sig is None or sig in seen:
                    continue
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(sig)
                single, combined = keys_of(tokens, shared.value)
                parts.append((single, combined, sig, len(tokens)))
            if parts:
                counts = np.array([len(single) + len(combined) for single, combined, _, _ in parts])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([key for part in parts for key in part[:2]]).view(np.int64)),
                    pa.array(np.repeat(np.array([part[2] for part in parts], dtype=np.int64), counts)),
                    pa.array(np.repeat(np.array([part[3] for part in parts], dtype=np.int32), counts)),
                    pa.array(np.repeat(np.array([len(part[0]) for part in parts], dtype=np.int32), counts)),
                    pa.array(np.repeat(counts.astype(np.int32), counts)),
                    pa.array(np.concatenate([np.arange(len(a) + len(b)) >= len(a) for a, b, _, _ in parts]))],
                    ["key", "sig", "n", "singles", "total", "combined"])

    return pick(docs, "text").mapInArrow(task, "key long, sig long, n int, singles int, total int, combined boolean")


#: A set is compared with a hub if they share this part of the set's keys, one in so many.
STAR_SHARE = 4
#: A leading key that more sets have brings them into a cluster, whose sets are compared in blocks; pairs are not made.
HOT_KEY = 64
#: Sets, and bytes of sketches, of such a block.
BLOCK_SETS, BLOCK_BYTES = 512, 262_144
#: Rounds of comparing with hubs, and hubs of a key in each. More of them leave fewer pairs to the end; the result is the same.
ROUNDS, HUBS = 2, 6


def members(all_keys: DataFrame) -> DataFrame:
    """The keys that different sets share, each set once, with the number of the key's rows."""
    group = "partition by key"
    found = all_keys.selectExpr(
        "*", f"lag(sig) over ({group} order by sig) as before", f"min(sig) over ({group}) as first",
        f"max(sig) over ({group}) as last", f"count(1) over ({group}) as times")
    return found.where("first <> last and (before is null or before <> sig)").drop("before", "first", "last")


def with_lead(found: DataFrame) -> DataFrame:
    """Leaves out sets that share too few tokens to link; lead marks the keys that are enough to find each link by.

    These are the combinations, and the least shared of the single keys as far
    as a link may miss the others. ``most`` is how many tokens a set may have
    in common with a set whose prefix reaches as far or farther in the order:
    all but those whose single key no other set has. A set whose prefix ends
    earlier may hold such a token beyond its prefix, so of two sets that link
    the greater ``most`` bounds what they have in common, not the lesser one.
    """
    smallest = f"(({OVER} * n + {UNDER - 1}) div {UNDER})"  # tokens of the smallest set it may link to
    must = f"greatest(1, {smallest} div {TOKENS_PER_SHARED})"
    ranked = found.selectExpr(
        "*", "cast(sum(int(not combined)) over (partition by sig) as int) as held",
        "row_number() over (partition by sig, combined order by times, key) as place").withColumn(
        "most", F.expr("n - singles + held"))
    return ranked.where(f"(combined or held >= {must}) and most >= {smallest}").selectExpr(
        "key", "sig", "n", "most", "total", "times", f"combined or place <= held - {must} + 1 as lead")


#: Whether sets of these sizes, with so many tokens in common with any other, may link.
SIZES_ALLOW = (f"{UNDER} * least(a_n, b_n) >= {OVER} * greatest(a_n, b_n) and "
               f"{UNDER + OVER} * greatest(a_most, b_most) >= {OVER} * (a_n + b_n)")


def apart(found: DataFrame, joined: DataFrame | None) -> DataFrame:
    """Adds each set's component and leaves the keys that sets of different components share."""
    if joined is None:
        own = found.withColumn("component", F.col("sig"))
    else:
        own = found.join(joined.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
            "component", F.coalesce("component", "sig"))
    ends = own.selectExpr("*", "min(component) over (partition by key) as low", "max(component) over (partition by key) as high")
    return stored(ends.where("low <> high").drop("low", "high"), "members-apart")


def star_pairs(own: DataFrame, number: int) -> DataFrame:
    """For each set the hubs of other components it shares most keys with, if they are a good part of its keys.

    A key's hubs are the sets that are least once their signatures are turned by
    numbers of the round's own; most keys have few sets, and so fewer hubs than turns.
    """
    rng = np.random.default_rng(number)
    turns = [int(turn) for turn in rng.integers(0, 2 ** 63 - 1, HUBS)]
    hubs = own.groupBy("key").agg(F.array_distinct(F.array(*(
        F.expr(f"min(sig ^ {turn}L) ^ {turn}L") for turn in turns))).alias("hubs"))
    rows = own.select("key", "sig", "total").join(hubs, "key").select(
        "sig", "total", F.explode(F.array_remove("hubs", F.col("sig"))).alias("hub"))
    shared = rows.groupBy("sig", "hub").agg(F.count(F.lit(1)).alias("shared"), F.max("total").alias("total")).where(
        STAR_SHARE * F.col("shared") >= F.col("total"))
    # A set shares a good part of its keys with few hubs, no more than it has keys.
    best = shared.groupBy("sig").agg(F.slice(F.sort_array(F.collect_list(F.struct("shared", "hub")), False), 1, HUBS).alias(
        "best")).select(F.col("sig").alias("a_sig"), F.explode("best.hub").alias("b_sig"))
    of = lambda name: own.select(*(
        F.col(c).alias(f"{name}_{c}") for c in ("sig", "n", "most", "component"))).distinct()
    return best.join(of("a"), "a_sig").join(of("b"), "b_sig").where("a_component <> b_component").where(
        SIZES_ALLOW).select(F.least("a_sig", "b_sig").alias("a"), F.greatest("a_sig", "b_sig").alias("b")).distinct()


def cross_pairs(own: DataFrame) -> DataFrame:
    """Pairs of sets of different components, of sizes that allow a link, that share a leading key few sets have."""
    own = own.where(f"lead and times <= {HOT_KEY}").select("key", "sig", "n", "most", "component")
    parts = own.select("key", "component").distinct()
    two = parts.alias("a").join(parts.alias("b"), "key").where("a.component < b.component").selectExpr(
        "key", "a.component as one", "b.component as two")
    side = lambda name, by: own.select(
        "key", F.col("component").alias(by), *(F.col(c).alias(f"{name}_{c}") for c in ("sig", "n", "most")))
    return two.join(side("a", "one"), ["key", "one"]).join(side("b", "two"), ["key", "two"]).where(SIZES_ALLOW).select(
        F.least("a_sig", "b_sig").alias("a"), F.greatest("a_sig", "b_sig").alias("b")).distinct()


def bit_table(ids: DataFrame) -> DataFrame:
    """The filter's words that have a bit set for some doc_id: at most FILTER_BITS / 64 rows, so it may be broadcast."""
    return ids.where("doc_id is not null").groupBy(F.expr(
        f"cast(shiftright(pmod(xxhash64(doc_id), {FILTER_BITS}), 6) as int)").alias("word")).agg(F.bit_or(F.expr(
            f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {FILTER_BITS}) & 63 as int))")).alias("bits"))


def suspected(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Adds hit: true for every row whose doc_id is among the ids, and for few others; no row is shuffled."""
    word = F.expr(f"cast(shiftright(pmod(xxhash64(doc_id), {FILTER_BITS}), 6) as int)")
    return rows.withColumn("word", word).join(F.broadcast(bit_table(ids)), "word", "left").withColumn(
        "hit", F.coalesce(F.expr(f"doc_id is not null and getbit(bits, cast(pmod(xxhash64(doc_id), {FILTER_BITS}) "
                                 "& 63 as int)) = 1"), F.lit(False))).drop("word", "bits")


def sketch(tokens: np.ndarray) -> bytes:
    """A bit for each token in a vector of eight to sixteen times as many bits, a power of two."""
    bits = np.zeros(8 << max(len(tokens) - 1, 0).bit_length(), dtype=np.uint8)
    bits[(tokens % np.uint64(len(bits))).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def most_common(one: np.ndarray, two: np.ndarray, n_one: int, n_two: int) -> int:
    """Tokens two sets have in common at most, by their sketches.

    A bit both have set stands for one common token at most, but for the
    tokens that had to share a bit with another one.
    """
    size = min(len(one), len(two))
    one, two = (np.bitwise_or.reduce(side.reshape(-1, size), axis=0) for side in (one, two))
    count = lambda bits: int(np.bitwise_count(bits).sum())
    return count(one & two) + min(n_one - count(one), n_two - count(two))


def may_link(one: pa.Scalar, two: pa.Scalar, n_one: int, n_two: int) -> bool:
    one, two = (np.frombuffer(side.as_buffer(), dtype=np.uint8) for side in (one, two))
    return (UNDER + OVER) * most_common(one, two, n_one, n_two) >= OVER * (n_one + n_two)


def do_link(one: pa.Scalar, two: pa.Scalar, n_one: int, n_two: int) -> bool:
    one, two = (np.frombuffer(side.as_buffer(), dtype=np.uint64) for side in (one, two))
    common = len(np.intersect1d(one, two, assume_unique=True))
    return UNDER * common >= OVER * (n_one + n_two - common)


def forms_of(docs: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """sig, n, sketch and tokens of the sets that share enough keys, made anew from the texts of one document each.

    Texts without an id are all made anew, as no filter of ids can tell which are needed.
    """
    needed = found.select("sig").distinct()
    ids = sets.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("doc_id")).join(needed, "sig")
    rows = suspected(pick(docs, "doc_id", "text"), ids).where("hit or doc_id is null").select("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches):
            made = [tokens for tokens in shingles(words_of(chunk.column(0).to_pylist()), SIZE) if len(tokens)]
            yield pa.RecordBatch.from_arrays([
                pa.array([signature(tokens) for tokens in made], pa.int64()),
                pa.array([len(tokens) for tokens in made], pa.int32()),
                pa.array([sketch(tokens) for tokens in made], pa.binary()),
                pa.array([tokens.tobytes() for tokens in made], pa.binary())], ["sig", "n", "sketch", "tokens"])

    made = rows.mapInArrow(task, "sig long, n int, sketch binary, tokens binary")
    return stored(made.join(needed, "sig", "left_semi").dropDuplicates(["sig"]), "forms")


def passing(forms: DataFrame, pairs: DataFrame, form: str, test) -> DataFrame:
    """The pairs that pass a test on a form of their sets."""
    needed = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
    own = forms.select("sig", "n", F.col(form).alias("form")).join(needed, "sig", "left_semi")
    side = lambda name: own.select(
        F.col("sig").alias(name), F.col("n").alias(f"n_{name}"), F.col("form").alias(f"form_{name}"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = [test(*values) for values in zip(
                batch.column("form_a"), batch.column("form_b"),
                batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    return stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(task, "a long, b long"), "passed")


def compared(forms: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs of signatures whose sets reach the similarity: first by sketches, which rule most others out, then whole."""
    return passing(forms, passing(forms, stored(pairs, "pairs"), "sketch", may_link), "tokens", do_link)


def hot_blocks(own: DataFrame, forms: DataFrame) -> DataFrame:
    """Blocks of the sets that share hot keys, by cluster; sets of one component lie side by side.

    Sets with a hot leading key in common are in one cluster. The clusters are
    sorted in ranges and cut into blocks where they lie, so none is ever whole
    in one task.
    """
    hot = own.where(f"lead and times > {HOT_KEY}")
    clusters = components(hot.selectExpr("sig as a", "min(sig) over (partition by key) as b").distinct())
    rows = clusters.select(F.col("node").alias("sig"), F.col("component").alias("cluster")).join(
        own.select("sig", "most", "component").distinct(), "sig").join(forms.select("sig", "n", "sketch"), "sig")
    rows = stored(rows.select("cluster", "component", "n", "most", "sig", "sketch"), "hot-sets")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def packed() -> pa.RecordBatch:
            block = pa.Table.from_batches(held).combine_chunks()
            get = lambda name, kind: pa.array([block.column(name).to_numpy().astype(kind).tobytes()])
            least = lambda name: pa.array([pc.min(block.column(name)).as_py()])
            greatest = lambda name: pa.array([pc.max(block.column(name)).as_py()])
            return pa.RecordBatch.from_arrays([
                least("cluster"), pa.array([(part << 32) + number]), get("component", np.int64), get("n", np.int64),
                get("most", np.int64), get("sig", np.int64),
                pa.array([[value.as_py() for value in block.column("sketch")]], pa.list_(pa.binary())),
                least("component"), greatest("component"), least("n"), greatest("n")], BLOCK_NAMES)

        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            bytes_of = pc.binary_length(batch.column("sketch")).to_numpy()
            for row in range(batch.num_rows):
                if held and (len(held) >= BLOCK_SETS or size >= BLOCK_BYTES or held[0].column("cluster")[0].as_py() != cluster[row]):
                    yield packed()
                    number, held, size = number + 1, [], 0
                held.append(batch.slice(row, 1))
                size += int(bytes_of[row])
        if held:
            yield packed()

    ranges = max(1, -(-rows.count() // (4 * BLOCK_SETS)))
    order = ["cluster", "component", "n", "sig"]
    return stored(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(task, BLOCK_KINDS), "hot-blocks")


BLOCK_NAMES = ["cluster", "block", "components", "ns", "mosts", "sigs", "sketches", "low", "high", "least", "greatest"]
BLOCK_KINDS = ("cluster long, block long, components binary, ns binary, mosts binary, sigs binary, sketches array<binary>, "
               "low long, high long, least long, greatest long")


def folded_bits(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches of at least a number of bytes, folded to it, as rows of 0 and 1."""
    folded = np.stack([np.bitwise_or.reduce(np.frombuffer(one, dtype=np.uint8).reshape(-1, size), axis=0) for one in sketches])
    return np.unpackbits(folded, axis=1).astype(np.float32)


def block_pairs(one: dict, two: dict, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the sets in two blocks that may link and are of different components."""
    found = []
    sizes = [np.array([len(sketch) for sketch in block["sketches"]]) for block in (one, two)]
    for left in np.unique(sizes[0]):
        for right in np.unique(sizes[1]):
            if max(left, right) > 2 * min(left, right):
                continue  # set sizes that differ by more than a link allows
            i, j = np.flatnonzero(sizes[0] == left), np.flatnonzero(sizes[1] == right)
            x, y = (folded_bits([block["sketches"][n] for n in rows], int(min(left, right)))
                    for block, rows in ((one, i), (two, j)))
            n_x, n_y = one["ns"][i][:, None], two["ns"][j][None, :]
            spare = np.minimum(n_x - x.sum(1).astype(np.int64)[:, None], n_y - y.sum(1).astype(np.int64)[None, :])
            common = np.minimum((x @ y.T).astype(np.int64) + spare, np.maximum(one["mosts"][i][:, None], two["mosts"][j][None, :]))
            may = ((UNDER + OVER) * common >= OVER * (n_x + n_y)) & (
                one["components"][i][:, None] != two["components"][j][None, :])
            if same:
                may &= i[:, None] < j[None, :]
            a, b = np.nonzero(may)
            found.append((i[a], j[b]))
    return tuple(np.concatenate([side[n] for side in found]) if found else np.empty(0, dtype=np.int64) for n in (0, 1))


def hot_pairs(blocks: DataFrame) -> DataFrame:
    """Pairs of sets of one cluster that may link by their sketches; blocks within one component are passed over."""
    side = lambda name: blocks.select("cluster", *(F.col(c).alias(f"{name}_{c}") for c in BLOCK_NAMES[1:]))
    both = side("a").join(side("b"), "cluster").where(
        f"a_block <= b_block and not (a_low = b_high and a_high = b_low) "
        f"and {UNDER} * a_greatest >= {OVER} * b_least and {UNDER} * b_greatest >= {OVER} * a_least")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                def block(name: str) -> dict:
                    numbers = {c: np.frombuffer(batch.column(f"{name}_{c}")[row].as_buffer(), dtype=np.int64)
                               for c in ("components", "ns", "mosts", "sigs")}
                    return {**numbers, "sketches": batch.column(f"{name}_sketches")[row].as_py()}

                one, two = block("a"), block("b")
                same = batch.column("a_block")[row].as_py() == batch.column("b_block")[row].as_py()
                i, j = block_pairs(one, two, same)
                a, b = one["sigs"][i], two["sigs"][j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return both.mapInArrow(task, "a long, b long")


def links_between(docs: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """Links that connect whatever is connected: those with hubs, round by round, then all that are left between components."""
    forms = forms_of(docs, sets, found)
    links, joined = None, None
    for number in range(ROUNDS):
        fresh = compared(forms, star_pairs(apart(found, joined), number))
        if fresh.isEmpty():
            break
        links = fresh if links is None else links.union(fresh)
        joined = components(links)
    own = apart(found, joined)
    for fresh in (compared(forms, cross_pairs(own)),
                  passing(forms, stored(hot_pairs(hot_blocks(own, forms)), "hot-pairs"), "tokens", do_link)):
        links = fresh if links is None else links.union(fresh)
    return links


def named_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, n and sig of each document; and for each sig its component_id and the sig of the document that names it."""
    made = stored(sets_and_counts(docs), "sets")
    sets = made.where("token is null").select("doc_id", "n", "sig")
    frequent = frequent_tokens(made, sets.where("sig is not null").count())
    found = stored(with_lead(members(keys(docs, frequent))), "members")
    joined = components(links_between(docs, sets, found)).withColumnRenamed("node", "sig")
    nodes = sets.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("least")).join(
        joined, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    name = F.min(F.when(F.col("least").isNotNull(), F.struct("least", "sig")))  # of equal ids the least signature
    named = nodes.join(nodes.groupBy("component").agg(name.alias("name")), "component")
    return sets, named.select("sig", F.col("name.least").alias("component_id"), F.col("name.sig").alias("keeper"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, the least doc_id reachable over links, one row per document."""
    sets, named = named_sets(docs)
    return sets.join(named, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def with_signatures(rows: DataFrame) -> DataFrame:
    """Adds sig, that of the text's set; null for an empty set."""
    schema = T.StructType([*rows.schema.fields, T.StructField("sig", T.LongType())])
    at = rows.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches):
            found = [signature(tokens) if len(tokens) else None
                     for tokens in shingles(words_of(chunk.column(at).to_pylist()), SIZE)]
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(found, pa.int64())], schema.names)

    return rows.mapInArrow(task, schema)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, with one row of each class of near copies: that with the least doc_id, of several texts under it one.

    Rows are judged one by one, so an id that comes with two texts keeps the one
    that nothing before it resembles. Of rows with equal ids and equal sets the
    least text, language, source and length stays. Documents with an empty set or
    a null id always stay. Only rows that a filter of fixed size suspects of
    sharing an id with one that has to go are looked at again and shuffled;
    the rest stay where they were read.
    """
    rows = pick(docs, "doc_id", "text", "lang", "source", "n_chars")
    names = rows.columns
    sets, named = named_sets(docs)
    # Each id with each of its sets: how often, and whether it is the row its class keeps.
    each = sets.where("doc_id is not null and sig is not null").groupBy("doc_id", "sig").agg(
        F.count(F.lit(1)).alias("times")).join(named, "sig").select(
        "doc_id", "sig", "times", (F.col("component_id").eqNullSafe(F.col("doc_id")) & (F.col("keeper") == F.col("sig"))).alias("stays"))
    special = stored(each.where("times > 1 or not stays").select("doc_id", "sig", "stays"), "special")
    marked = suspected(rows, special)
    hits = with_signatures(marked.where("hit").select(*names))
    stay = hits.join(special.select("doc_id", "sig"), ["doc_id", "sig"], "left_anti").select(*names)
    repeated = hits.join(special.where("stays").select("doc_id", "sig"), ["doc_id", "sig"])
    once = repeated.groupBy("doc_id", "sig").agg(F.min(F.struct(*names)).alias("row")).select("row.*")
    return marked.where("not hit").select(*names).union(stay).union(once)
