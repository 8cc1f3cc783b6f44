"""N-gram Jaccard join: exact links between word-shingle sets and their connected groups.

Two texts link when ``100 * |A & B| >= percent * |A | B|`` over their distinct
shingles. Every pair of texts over the threshold ends up in one group; no pair
inside a group that is already known needs to be looked at. Three kinds of set
relations save the work:

* *Equal sets* are one node; the copies take the node's answers.
* *Block skip*: the index holds prefix tokens only. Lists are ordered by set
  size, so a scan compares a posting with the next ones and leaves a pair by
  size and by position before any set is read; long lists are joined per block
  of sizes within the threshold's reach of each other.
* *Derived answers*: sets that a cheap first round verified against a similar
  set take over the group that set is in. Only candidates between different
  groups are verified after that, and a long list whose sets are all in one
  group is skipped as a whole.

Sets are compared exactly on 64-bit shingle hashes. A parity sketch gives a
true lower bound of the symmetric difference, so leaving a pair by it loses
nothing. Tokens held by many sets are ordered last (a bounded list of the most
frequent; the order changes cost, never results).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm import textbytes as tb
from veilframe.llm.common import KeyFilter, components, is_empty, met_before, with_earlier
from veilframe.session import materialize

FREQUENT_TOKENS = 1 << 16  # at most so many tokens are ordered last; half a megabyte goes to each task
FREQUENT_FROM = 32
WINDOW = 16  # postings a scan looks ahead; longer lists get a second, exact round
LEADERS = 8
LEADER_BYTES = 32 << 20  # of leaders a task remembers


def prefix_length(n: int, percent: int) -> int:
    """So many first tokens of a set of n must hold one that any linked set shares."""
    return n - -(-n * percent // 100) + 1


def _sets(batches: Iterator[pa.RecordBatch], size: int):
    """(id, set) of each text, whole texts, in slices of bounded bytes."""
    for batch in batches:
        for part in tb.slices(batch, "text"):
            data, offsets = tb.flat(part.column("text"))
            hashes, starts, _ = tb.words(data, offsets, tb.SPACE)
            found = tb.shingle_sets(hashes, tb.word_bounds(starts, offsets), size)
            yield from zip(part.column("id").to_pylist(), found)


def _signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def _parity(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Bit i is the parity of the tokens that fall on i."""
    odd = np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def _sketch_bits(n: int) -> int:
    return max(64, 1 << max(0, (n - 1).bit_length() - 1))


def _pair_key(tokens: np.ndarray) -> int:
    """Key of the cheap first round: the two smallest tokens."""
    first = tokens[:2]
    return int(_signed(tb.mix(first[:1] + (first[-1:] * np.uint64(0x9E3779B97F4A7C15))))[0])


class _Out:
    """Rows gathered into batches of a bounded number of cells."""

    def __init__(self, schema: pa.Schema, most: int = 1 << 20):
        self.schema, self.most, self.rows, self.weight = schema, most, [[] for _ in schema], 0

    def add(self, weight: int, *values) -> bool:
        for into, value in zip(self.rows, values):
            into.append(value)
        self.weight += weight
        return self.weight >= self.most

    def take(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(self.rows, self.schema)], schema=self.schema)
        self.rows, self.weight = [[] for _ in self.schema], 0
        return out


_SIGNED_SCHEMA = pa.schema([
    ("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("near", pa.int64()), ("sketch", pa.binary()),
    ("s0", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("s3", pa.int64()), ("first", pa.list_(pa.int64())),
])
_SIGNED_SQL = "id long, n long, digest binary, near long, sketch binary, s0 long, s1 long, s2 long, s3 long, first array<long>"


def _sign(size: int, percent: int):
    def run(batches):
        out = _Out(_SIGNED_SCHEMA)
        for key, tokens in _sets(batches, size):
            n = len(tokens)
            if not n:
                full = out.add(16, key, 0, None, None, None, 0, 0, 0, 0, None)
            else:
                fold = np.frombuffer(_parity(tokens, 256).tobytes(), np.int64).tolist()
                first = tokens[: 1 + prefix_length(n, percent) * 5 // 4]
                full = out.add(
                    len(first) + 16, key, n, hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), _pair_key(tokens),
                    _parity(tokens, _sketch_bits(n)).tobytes(), *fold, _signed(first),
                )
            if full:
                yield out.take()
        yield out.take()

    return run


def _emit_sets(size: int, keep: KeyFilter):
    """(id, set) of the texts whose id may be wanted; a repeated row once per task."""
    schema = pa.schema([("id", pa.int64()), ("tokens", pa.binary())])

    def run(batches):
        out, seen = _Out(schema), set()
        for key, tokens in _sets(batches, size):
            if not len(tokens) or not keep.holds(np.array([key]))[0]:
                continue
            mark = key, hash(raw := tokens.tobytes())
            if mark not in seen:
                seen.add(mark)
                if out.add(len(tokens), key, raw):
                    yield out.take()
        yield out.take()

    return run


def _near_leader(tokens: np.ndarray, leaders: list, percent: int):
    """The first known set, newest first, that this one links to."""
    n = len(tokens)
    for other, theirs in reversed(leaders):
        low, high = min(n, len(theirs)), max(n, len(theirs))
        if 100 * low >= percent * high and linked(_overlap(tokens, theirs), low, high, percent):
            return other
    return None


_NEAR_SCHEMA = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("peer", pa.int64()), ("tokens", pa.binary())])


def _near_sets(size: int, percent: int, keep: KeyFilter):
    """Map side of the first round: a set that links to one this task has sent goes as an edge, not as a set."""

    def run(batches):
        out, seen, known, held = _Out(_NEAR_SCHEMA), set(), {}, 0
        for node, tokens in _sets(batches, size):
            if not len(tokens):
                continue
            key = _pair_key(tokens)
            if not keep.holds(np.array([key]))[0]:
                continue
            digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
            if digest in seen:
                continue
            seen.add(digest)
            leaders = known.setdefault(key, [])
            peer = _near_leader(tokens, leaders, percent)
            if peer is None:
                known[key] = [*leaders[1 - LEADERS :], (node, tokens)]
                held += tokens.nbytes
                if held > LEADER_BYTES:
                    known, held = {}, 0
                full = out.add(len(tokens), key, node, len(tokens), None, tokens.tobytes())
            else:
                full = out.add(1, key, node, len(tokens), peer, None)
            if full:
                yield out.take()
        yield out.take()

    return run


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int((large[at] == small).sum())


def linked(common: int, a: int, b: int, percent: int) -> bool:
    return common > 0 and 100 * common >= percent * (a + b - common)


def _first_round(percent: int):
    """Rows sorted by key and size: each set against the last few leaders of its key; links found are exact."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        key, leaders, out = None, [], _Out(schema, 1 << 16)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("key", "id", "peer")), batch.column("tokens"))
            for k, node, peer, raw in rows:
                if peer is None:
                    tokens = np.frombuffer(raw.as_buffer(), np.uint64)
                    if k != key:
                        key, leaders = k, []
                    peer = _near_leader(tokens, leaders, percent)
                    if peer is None:
                        leaders = [*leaders[1 - LEADERS :], (node, tokens.copy())]
                if peer is not None and peer != node and out.add(1, node, peer):
                    yield out.take()
        yield out.take()

    return run


def _post(size: int, percent: int, frequent: np.ndarray):
    """Prefix tokens in the common order; equal sets once per task."""
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("same", pa.int64())])

    def run(batches):
        seen, held, weight = set(), [], 0
        for node, tokens in _sets(batches, size):
            n = len(tokens)
            if not n:
                continue
            digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
            if digest in seen:
                continue
            seen.add(digest)
            if len(frequent):
                at = np.searchsorted(frequent, tokens)
                at[at == len(frequent)] = 0
                late = frequent[at] == tokens
                tokens = np.concatenate([tokens[~late], tokens[late]])
            first = tokens[: prefix_length(n, percent)]
            held.append((first, node, n, int.from_bytes(digest[:8], "little", signed=True)))
            weight += len(first)
            if weight >= 1 << 17:
                yield _posting_batch(held, schema)
                held, weight = [], 0
        yield _posting_batch(held, schema)

    return run


def _posting_batch(held, schema) -> pa.RecordBatch:
    counts = np.array([len(h[0]) for h in held], np.int64)
    spread = lambda i, kind: np.repeat(np.array([h[i] for h in held], kind), counts)
    tokens = np.concatenate([h[0] for h in held]) if held else np.zeros(0, np.uint64)
    pos = np.concatenate([np.arange(c) for c in counts]) if held else np.zeros(0)
    return pa.RecordBatch.from_arrays(
        [pa.array(_signed(tokens)), pa.array(spread(1, np.int64)), pa.array(spread(2, np.int32)), pa.array(pos.astype(np.int32)), pa.array(spread(3, np.int64))],
        schema=schema,
    )


def _scan(percent: int):
    """Postings in (token, n, same, node) order: pairs within the window, and every posting of a longer list."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("na", pa.int32()), ("nb", pa.int32()), ("same", pa.int64()), ("long", pa.bool_())])
    names = ("token", "node", "n", "pos", "same")
    reach = WINDOW + 1

    def batch_of(columns, long):
        kinds = (np.int64, np.int64, np.int32, np.int32, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(c.astype(k)) for c, k in zip(columns, kinds)] + [pa.array(np.full(len(columns[0]), long))], schema=schema
        )

    def run(batches):
        carry = {k: np.zeros(0, np.int64) for k in names}  # the last rows of the last list, as far as the window reaches
        length = 0  # of the last list so far
        for batch in batches:
            new = {k: batch.column(k).to_numpy().astype(np.int64) for k in names}
            # Equal sets sent by several tasks stand side by side: the first stays.
            token, same = (np.concatenate([carry[k][-1:], new[k]]) for k in ("token", "same"))
            again = (token[1:] == token[:-1]) & (same[1:] == same[:-1])
            keep = np.ones(batch.num_rows, bool)
            keep[batch.num_rows - len(again) :] = ~again
            c = len(carry["token"])
            row = {k: np.concatenate([carry[k], new[k][keep]]) for k in names}
            token, node, n, pos = (row[k] for k in names[:4])
            total = len(token)
            if total == c:
                continue
            pairs = []
            for d in range(1, min(WINDOW, total - 1) + 1):
                i = np.flatnonzero(token[d:] == token[:-d])
                if not len(i):
                    break
                i = i[i + d >= c]
                j = i + d
                room = np.minimum(n[i] - pos[i], n[j] - pos[j])
                ok = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
                ok &= ((100 + percent) * room >= percent * (n[i] + n[j])) & (node[i] != node[j])
                i, j = i[ok], j[ok]
                i, j = np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)
                pairs.append((node[i], node[j], n[i], n[j], np.zeros(len(i))))
            if pairs:
                yield batch_of([np.concatenate(x) for x in zip(*pairs)], False)
            begin = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            place = np.arange(total) - np.repeat(begin, np.diff(np.append(begin, total)))
            if c:
                place[: begin[1] if len(begin) > 1 else total] += length - c
            over = np.flatnonzero(place >= reach)
            over = over[over >= c]
            if len(over):
                start = over[place[over] == reach]
                before = (start[:, None] - np.arange(1, reach + 1)[None, :]).ravel()
                at = np.concatenate([before, over])
                yield batch_of((token[at], node[at], n[at], pos[at], row["same"][at]), True)
            length = int(place[-1]) + 1
            carry = {k: v[max(int(begin[-1]), total - reach) :] for k, v in row.items()}

    return run


def _bound(percent: int):
    """Pairs with sketches: stay only where the parity bound leaves the threshold in reach."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("apart", pa.int32())])

    def run(batches):
        for batch in batches:
            a, b, apart = [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "sa", "sb")))
            for x, y, n, m, p, q in rows:
                p, q = np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)
                while len(p) > len(q):
                    p = p[: len(p) // 2] ^ p[len(p) // 2 :]
                while len(q) > len(p):
                    q = q[: len(q) // 2] ^ q[len(q) // 2 :]
                least = int(np.bitwise_count(p ^ q).sum())
                if (100 + percent) * (n + m - least) >= 2 * percent * (n + m):
                    a.append(x), b.append(y), apart.append(least)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((a, b, apart), schema)], schema=schema)

    return run


def _verify_rows(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            a, b = [], []
            for x, y, p, q in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("ta"), batch.column("tb")):
                p, q = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                if linked(_overlap(p, q), len(p), len(q), percent):
                    a.append(x), b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (a, b)], schema=schema)

    return run


def _verified(texts: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by whole sets read again from the texts."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    keep = KeyFilter.of(ids, "id")
    wanted = materialize(texts.mapInArrow(_emit_sets(size, keep), "id long, tokens binary"), "sets")
    left = pairs.join(wanted.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a")
    both = left.join(wanted.select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(_verify_rows(percent), "a long, b long")


def _across(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet known to be in one group."""
    left = groups.select(F.col("node").alias("a"), F.col("component").alias("ga"))
    right = groups.select(F.col("node").alias("b"), F.col("component").alias("gb"))
    known = pairs.join(left, "a", "left").join(right, "b", "left")
    return known.where(F.coalesce("ga", "a") != F.coalesce("gb", "b")).drop("ga", "gb")


def _bounded(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    left = signed.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = signed.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_bound(percent), "a long, b long, apart int")


def _long_pairs(postings: DataFrame, groups: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """Exact rest of lists longer than the window: pairs between groups, joined per block of set sizes.

    Blocks grow by the threshold's ratio, so linked sizes fall into the same or
    neighbouring blocks. Position and a folded parity sketch are part of the
    join condition. Two sets meet in every list of a token they share; a list
    leaves out those known to meet in an earlier one, in the common order.
    """
    folded = signed.select(F.col("id").alias("node"), "s0", "s1", "s2", "s3").dropDuplicates(["node"])
    rows = postings.join(groups, "node", "left").withColumn("g", F.coalesce("component", "node")).drop("component")
    open_lists = rows.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low <> high").select("token")
    open_lists = materialize(open_lists, "open-lists")
    block = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent)) + 1e-9).cast("int")
    rows = with_earlier(rows.join(open_lists, "token", "left_semi"), "token", "pos", "node", "same").join(folded, "node").withColumn("block", block)
    side = lambda p: [F.col(c).alias(f"{p}{c}") for c in ("node", "n", "pos", "g", "s0", "s1", "s2", "s3", "earlier")]
    left = rows.select("token", "block", *side("l_"))
    right = rows.withColumn("block", F.explode(F.array(F.col("block"), F.col("block") - 1))).select("token", "block", *side("r_"))
    size = F.col("l_n") + F.col("r_n")
    apart = sum((F.bit_count(F.col(f"l_s{i}").bitwiseXOR(F.col(f"r_s{i}"))) for i in range(4)), F.lit(0))
    room = F.least(F.col("l_n") - F.col("l_pos"), F.col("r_n") - F.col("r_pos"))
    fits = (
        (F.col("l_g") != F.col("r_g")) & (100 * F.least("l_n", "r_n") >= percent * F.greatest("l_n", "r_n"))
        & ((100 + percent) * room >= percent * size) & ((100 + percent) * (size - apart) >= 2 * percent * size)
        & ~met_before("l_earlier", "r_earlier")
    )
    joined = left.join(right, ["token", "block"]).where(fits)
    return joined.select(F.least("l_node", "r_node").alias("a"), F.greatest("l_node", "r_node").alias("b")).distinct()


def jaccard_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``; the component is the smallest linked id.

    Other columns are ignored. Null and empty texts, and texts without words,
    have no shingles and are their own component. Repeated rows get the same
    answer each. A null id links nothing and has a null component. If an id
    repeats with different texts, the links of all of them count for the id.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = materialize(texts.mapInArrow(_sign(size, percent), _SIGNED_SQL), "signed")
    texts = texts.where("id is not null")
    usable = signed.where("id is not null and n > 0")

    # Round one: sets that share their two smallest tokens, against a few leaders.
    copies = usable.select("near", "digest").distinct()
    keys = copies.groupBy("near").agg(F.count("*").alias("sets")).where("sets > 1")
    near = texts.mapInArrow(_near_sets(size, percent, KeyFilter.of(keys, "near")), "key long, id long, n long, peer long, tokens binary")
    width = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = near.repartition(width, "key").sortWithinPartitions("key", "n", "id")
    edges = materialize(ordered.mapInArrow(_first_round(percent), "a long, b long"), "edges")
    groups = components(edges)

    # The index: prefix tokens, the most frequent ones ordered last.
    counts = usable.select(F.explode("first").alias("token")).groupBy("token").agg(F.count("*").alias("held")).where(F.col("held") >= FREQUENT_FROM)
    frequent = counts.orderBy(F.desc("held"), "token").limit(FREQUENT_TOKENS).select("token").toPandas()["token"].to_numpy(np.int64)
    frequent = np.sort(frequent.view(np.uint64))
    postings = texts.mapInArrow(_post(size, percent, frequent), "token long, node long, n int, pos int, same long")
    ordered = postings.repartition(width, "token").sortWithinPartitions("token", "n", "same", "node")
    scanned = materialize(ordered.mapInArrow(_scan(percent), "a long, b long, na int, nb int, same long, long boolean"), "scanned")

    fresh = _across(scanned.where("not long").select("a", "b").distinct(), groups)
    pairs = materialize(_bounded(fresh, usable, percent), "pairs")
    # Each set against its closest candidate first; whoever is still apart after that, against all.
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
    best = both.groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))
    best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = edges.unionByName(materialize(_verified(texts, best, size, percent), "edges"))
    groups = components(edges)
    tried = best
    rest = materialize(_across(pairs.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), groups), "rest")
    if not is_empty(rest):
        edges = edges.unionByName(materialize(_verified(texts, rest, size, percent), "edges"))
        groups = components(edges)
    long = scanned.where("long").select(F.col("a").alias("token"), F.col("b").alias("node"), F.col("na").alias("n"), F.col("nb").alias("pos"), "same").distinct()
    if not is_empty(long):
        rest = _long_pairs(long, groups, usable, percent)
        rest = rest.join(pairs.select("a", "b").distinct(), ["a", "b"], "left_anti")
        rest = materialize(_bounded(rest, usable, percent), "pairs").select("a", "b").distinct()
        if not is_empty(rest):
            edges = edges.unionByName(materialize(_verified(texts, rest, size, percent), "edges"))
            groups = components(edges)

    # Copies of a node's set take its group; the group is named by the smallest id of all of them.
    named = usable.select("id", "digest").join(groups, F.col("id") == F.col("node"), "left").select("id", "digest", "component")
    per_set = named.groupBy("digest").agg(F.min("id").alias("low"), F.min("component").alias("component"))
    per_set = per_set.withColumn("component", F.coalesce("component", "low"))
    smallest = per_set.groupBy("component").agg(F.min("low").alias("component_id"))
    answers = per_set.join(smallest, "component").select("digest", "component_id")
    out = signed.select("id", "n", "digest").join(answers, "digest", "left")
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
    )
