"""N-gram Jaccard join through a token-group matrix.

Texts are sets of word shingles. A set that links must share most tokens with another set, so over a
fixed range of the token space the matrix counts, for each token, the sets that hold it; a set with too
many tokens of its own can link to nothing and is left out. The others are partitioned into groups: the
token space is dealt into more parts than two linked sets can differ in tokens, so they agree on all of
some part, and groups closed under such agreement lose no link. A group stores its token union with the
number of members that hold each token; a member's overlap with the rest of the union bounds what it can
share, and those below the bound leave before the group is opened. Open groups are compared exactly, most
central member first, until everything outside the largest component has been compared with the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealens.llm.components import connected_components
from arealens.llm.words import chunks, mix, shingle_set, split_words
from arealens.operators.materialize import TEXT_ROWS, materialize

#: Share of the token space over which sets are counted for each token, for the first bound.
COUNTED = 0.25
#: Rows of the members' list up to which it is broadcast (8 MB); above, it is a shuffled join.
BROADCAST_MEMBERS = 500_000
#: A group with at most so many tokens is opened by one task; a larger one by rounds over all tasks.
TASK_TOKENS = 4 << 20
#: Members of a large group that a round compares with the whole group.
ROUND_PIVOTS = 512
#: A token counts as common from so many sets on. Common tokens are left out of the groups' keys where
#: the rest decides; they only affect how large groups get, never which links are found.
COMMON_SETS = 48
#: Bound of the list of common tokens sent to the tasks (8 MB).
COMMON_TOKENS = 1 << 20
_LEVELS = 8
_FLUSH_TOKENS = 1 << 20


def _needed(n: np.ndarray | int, percent: int):
    """Tokens that a set of ``n`` tokens must share at the least with a set it links to."""
    return -(-n * percent // 100)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for lo, hi, data, offsets in chunks(batch.column("text")):
        words = split_words(data, offsets, lower=True)
        for row in range(hi - lo):
            yield lo + row, shingle_set(words.hashes[words.first[row] : words.first[row + 1]], size)


def _node(tokens: np.ndarray) -> int:
    """Key of a set: the same for equal sets whatever their texts."""
    total = int(tokens.sum(dtype=np.uint64)) ^ (int((tokens * (tokens >> np.uint64(7) | np.uint64(1))).sum(dtype=np.uint64)) << 1)
    return ((total * 0x9E3779B97F4A7C15 + len(tokens)) & (1 << 64) - 1) - (1 << 63)


def _size_class(n: int, percent: int) -> tuple[list[int], int]:
    """Lower bounds of the size classes up to the one after ``n``'s, and ``n``'s class.

    Sets that link are in the same or in neighbouring classes.
    """
    bounds = [1]
    while bounds[-1] <= n:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return bounds, len(bounds) - 2


def _part_keys(tokens: np.ndarray, parts: int, salt: int) -> np.ndarray:
    """A key for each part in use when the token space is dealt into ``parts``: the part and all tokens in it."""
    at = ((tokens >> np.uint64(11)) % np.uint64(parts)).astype(np.int64)
    total = np.zeros(parts, np.uint64)
    np.add.at(total, at, mix(tokens ^ np.uint64(0xA5A5_1234_9876_5A5A)))
    used = np.flatnonzero(np.bincount(at, minlength=parts))
    return mix(total[used] ^ mix(used.astype(np.uint64) + np.uint64(salt << 32)))


def group_keys(tokens: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set: two sets that link have one in common.

    Under the class of the smaller of two linked sets they differ in at most ``differ`` tokens, so in at
    most that many parts. A set with more parts in use agrees with its partner on all of one; a set with
    fewer is dealt into more parts in further rounds, which its partner, if it has fewer too, also takes.
    Tokens in ``common`` (sorted) take part only in the last rounds, for sets whose others do not decide.
    """
    bounds, own = _size_class(len(tokens), percent)
    rare = tokens
    if len(common):
        rare = tokens[common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] != tokens]
    keys = []
    for label in (own, own - 1):
        if label < 0:
            continue
        differ = (bounds[label + 1] - 1) * (100 - percent) // percent
        first, level, found = differ + differ // 3 + 8, 0, 0
        while found <= differ:
            some = rare if level < _LEVELS else tokens
            keys.append(_part_keys(some, first << level % _LEVELS, label * 64 + level))
            found, level = len(keys[-1]), level + 1
            if found <= differ and level == 2 * _LEVELS:  # parts that no two of its tokens share
                keys.append(mix(tokens + np.uint64(label)))
                break
    return np.unique(np.concatenate(keys))


_LIMIT = np.uint64(int(COUNTED * 2**64))


def _scan(size: int):
    """Rows (doc_id, n, counted, node): tokens, those in the counted range, key of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, counted, node = np.zeros((3, batch.num_rows), np.int64)
            for row, tokens in _sets(batch, size):
                n[row], counted[row] = len(tokens), np.searchsorted(tokens, _LIMIT)
                if len(tokens):
                    node[row] = _node(tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(counted), pa.array(node, mask=n == 0)], names=["doc_id", "n", "counted", "node"]
            )

    return run


def _packed(size: int, buckets: int, choose, wanted: bool, named: bool = True):
    """Rows (bucket, tokens, nodes): the chosen tokens of the sets, packed by bucket.

    ``wanted``: the rows name the set they stand for in ``node``; a row of another set is passed over.
    ``named``: tokens carry their set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_held, nodes_held, total, seen = [], [], 0, set()

        def pack() -> Iterator[pa.RecordBatch]:
            tokens = np.concatenate(tokens_held)
            nodes = np.repeat(np.array([x for x, _ in nodes_held], np.int64), [k for _, k in nodes_held])
            bucket = ((tokens >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            tokens, nodes, bucket = tokens[order], nodes[order], bucket[order]
            cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1])
            sizes = np.diff(np.append(cut, len(bucket))) * 8
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            packs = [
                pa.Array.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(ends if len(x) else ends * 0), pa.py_buffer(np.ascontiguousarray(x).view(np.uint8))]).cast(pa.binary())
                for x in ((tokens, nodes) if named else (tokens, tokens[:0]))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut]), *packs], names=["bucket", "tokens", "nodes"])

        for batch in batches:
            asked = batch.column("node").to_pylist() if wanted else None
            for row, tokens in _sets(batch, size):
                if not len(tokens) or (node := _node(tokens)) in seen or wanted and asked[row] != node:
                    continue
                seen.add(node)
                if len(seen) > 1_000_000:
                    seen.clear()
                chosen = choose(tokens)
                if len(chosen):
                    tokens_held.append(chosen)
                    nodes_held.append((node, len(chosen)))
                    total += len(chosen)
                if total > _FLUSH_TOKENS:
                    yield from pack()
                    tokens_held, nodes_held, total = [], [], 0
        if total:
            yield from pack()

    return run


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Rows that follow each other with the same key."""
    now, rows = None, []
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        keys = columns[key].to_pylist()
        for i, k in enumerate(keys):
            if rows and k != now:
                yield now, rows
                rows = []
            now = k
            rows.append({name: column[i] for name, column in columns.items()})
    if rows:
        yield now, rows


def _matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each bucket its distinct (token, node) pairs in order, where tokens begin, and sets per token."""
    for _, rows in _runs(batches, "bucket"):
        tokens = np.concatenate([np.frombuffer(r["tokens"].as_buffer(), np.uint64) for r in rows])
        nodes = np.concatenate([np.frombuffer(r["nodes"].as_buffer(), np.int64) for r in rows])
        order = np.lexsort((nodes, tokens))
        tokens, nodes = tokens[order], nodes[order]
        same = (tokens[1:] == tokens[:-1]) & (nodes[1:] == nodes[:-1])
        keep = np.concatenate([[True], ~same])
        tokens, nodes = tokens[keep], nodes[keep]
        begin = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        yield tokens, nodes, begin, np.diff(np.append(begin, len(tokens)))


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, n): how many tokens of a set other sets hold too."""
    nodes_held, total = [], 0

    def rows() -> pa.RecordBatch:
        nodes, n = np.unique(np.concatenate(nodes_held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(n.astype(np.int64))], names=["node", "n"])

    for _, nodes, _, sets in _matrix(batches):
        nodes_held.append(nodes[np.repeat(sets > 1, sets)])
        total += len(nodes_held[-1])
        if total > _FLUSH_TOKENS:
            yield rows()
            nodes_held, total = [], 0
    if total:
        yield rows()


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (token, n): tokens that many sets hold."""
    for _, rows in _runs(batches, "bucket"):
        tokens, sets = np.unique(np.concatenate([np.frombuffer(r["tokens"].as_buffer(), np.uint64) for r in rows]), return_counts=True)
        often = sets >= COMMON_SETS
        if often.any():
            yield pa.RecordBatch.from_arrays([pa.array(tokens[often].view(np.int64)), pa.array(sets[often].astype(np.int64))], names=["token", "n"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) from each set that shares a key to the smallest set that has it."""
    for _, nodes, begin, sets in _matrix(batches):
        least = np.repeat(nodes[begin], sets)
        differ = least != nodes
        if differ.any():
            pairs = np.unique(np.stack([nodes[differ], least[differ]], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _member_tokens(size: int):
    """Rows (grp, node, tokens) for the documents that stand for a set of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, node = [], batch.column("node").to_pylist()
            for row, tokens in _sets(batch, size):
                if len(tokens) and _node(tokens) == node[row]:
                    rows.append((row, tokens.tobytes()))
            if rows:
                at = pa.array([r for r, _ in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("grp").take(at), batch.column("node").take(at), pa.array([t for _, t in rows], pa.binary())],
                    names=["grp", "node", "tokens"],
                )

    return run


def open_group(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component number of each of these sets (distinct tokens each) under links of ``percent`` similarity."""
    number = len(sets)
    label = np.arange(number)
    alive = np.ones(number, bool)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(number), size)
    token = np.unique(np.concatenate(sets), return_inverse=True)[1]
    need = _needed(size, percent)
    while True:  # the bound: tokens of a member that the rest of the union holds
        held = np.bincount(token)
        overlap = np.bincount(owner, weights=held[token] > 1, minlength=number)
        out = alive & (overlap < need)
        if not out.any():
            break
        alive &= ~out
        keep = alive[owner]
        token, owner = token[keep], owner[keep]
        if not len(token):
            return label
    order = np.argsort(token, kind="stable")
    posting, begin = owner[order], np.concatenate([[0], np.cumsum(np.bincount(token))])
    first = np.searchsorted(owner, np.arange(number + 1))
    central = np.bincount(owner, weights=held[token], minlength=number) / size
    waiting = [int(i) for i in np.argsort(-central, kind="stable") if alive[i]]
    members = {i: [i] for i in waiting}
    largest, compared = waiting[0], True
    while compared:  # until all that waits is in the largest component
        rest, compared = [], False
        for pivot in waiting:
            if label[pivot] == largest and len(members[largest]) > 1:
                rest.append(pivot)
                continue
            compared = True
            mine = token[first[pivot] : first[pivot + 1]]
            spans = begin[mine + 1] - begin[mine]
            at = np.repeat(begin[mine] - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
            both = np.bincount(posting[at], minlength=number)
            linked = (100 * both >= percent * (size[pivot] + size - both)) & (both > 0) & alive
            for other in np.unique(label[linked]):
                if other != label[pivot] and int(other) in members:
                    into, gone = sorted((int(label[pivot]), int(other)), key=lambda x: -len(members[x]))
                    label[members[gone]] = into
                    members[into] += members.pop(gone)
                    if largest == gone or len(members[into]) > len(members[largest]):
                        largest = into
        waiting = rest
    return label


def _open_groups(percent: int):
    """Rows (a, b): each member of a component and the component's smallest member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, "grp"):
            sets = {r["node"].as_py(): np.frombuffer(r["tokens"].as_buffer(), np.uint64) for r in rows}
            nodes = np.array(list(sets), np.int64)
            label = open_group(list(sets.values()), percent)
            least = np.full(len(nodes), np.iinfo(np.int64).max)
            np.minimum.at(least, label, nodes)
            linked = np.flatnonzero(least[label] != nodes)
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(least[label][linked])], names=["a", "b"])

    return run


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (grp, node, token) over a sixteenth of the token space, enough to order members by centrality."""
    for batch in batches:
        sets = [np.frombuffer(t.as_buffer(), np.uint64) for t in batch.column("tokens")]
        some = [s[s < np.uint64(1 << 60)].view(np.int64) for s in sets]
        at = pa.array(np.repeat(np.arange(len(some)), [len(s) for s in some]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("grp").take(at), batch.column("node").take(at), pa.array(np.concatenate([np.zeros(0, np.int64), *some]))], names=["grp", "node", "token"]
        )


def _pivot_links(percent: int):
    """Links (a, b) between members of a group and its pivots, which come first (member false) in a run of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, held, index = None, [], [], None
        for batch in batches:
            a, b = [], []
            for grp, member, node, tokens in zip(*(batch.column(c) for c in ("grp", "member", "node", "tokens"))):
                own = np.frombuffer(tokens.as_buffer(), np.uint64)
                if grp.as_py() != now:
                    now, names, held, index = grp.as_py(), [], [], None
                if not member.as_py():
                    names.append(node.as_py())
                    held.append(own)
                    continue
                if index is None and held:
                    token = np.concatenate(held)
                    order = np.argsort(token, kind="stable")
                    index = token[order], np.repeat(np.arange(len(held)), [len(h) for h in held])[order], np.array([len(h) for h in held])
                if index is None:
                    continue
                token, owner, size = index
                lo, hi = np.searchsorted(token, own), np.searchsorted(token, own, "right")
                spans = hi - lo
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
                both = np.bincount(owner[at], minlength=len(size))
                for k in np.flatnonzero((100 * both >= percent * (len(own) + size - both)) & (both > 0)):
                    if names[k] != node.as_py():
                        a.append(node.as_py())
                        b.append(names[k])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _large_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links inside groups too large for a task: rounds compare the next pivots of each group with all of it.

    A member is done once it was a pivot or sits in its group's largest component.
    """
    each = sets.mapInArrow(_sampled, "grp long, node long, token long")
    held = each.groupBy("grp", "token").agg(F.count("*").alias("held"))
    central = each.join(held, ["grp", "token"]).groupBy("grp", "node").agg(F.avg("held").alias("central"))
    begun = sets.select("grp", "node").join(central, ["grp", "node"], "left").fillna(0.0, ["central"])
    state = materialize(begun.select("grp", "node", "central", F.col("node").alias("label"), F.lit(False).alias("done")), "state")
    links, parts = None, int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        sizes = state.groupBy("grp", "label").count().groupBy("grp").agg(F.max(F.struct("count", "label")).alias("m"))
        main = sizes.select("grp", F.when(F.col("m.count") > 1, F.col("m.label")).alias("main"))
        open_ = state.join(main, "grp").where("not done and (main is null or label <> main)")
        rank = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("central"), "node"))
        chosen = materialize(open_.withColumn("rank", rank).where(F.col("rank") <= ROUND_PIVOTS).select("grp", "node"), "pivots")
        if chosen.isEmpty():
            break
        spread = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        pivots = sets.join(chosen, ["grp", "node"]).select("grp", spread.alias("salt"), F.lit(False).alias("member"), "node", "tokens")
        members = sets.select("grp", F.pmod(F.hash("node"), F.lit(parts)).alias("salt"), F.lit(True).alias("member"), "node", "tokens")
        together = pivots.unionByName(members).repartition(parts, "grp", "salt").sortWithinPartitions("grp", "salt", "member")
        found = materialize(together.mapInArrow(_pivot_links(percent), "a long, b long"), "links")
        links = found if links is None else links.union(found)
        label = connected_components(links).withColumnRenamed("label", "now")
        state = materialize(
            state.join(label, "node", "left")
            .join(chosen.withColumn("pivot", F.lit(True)), ["grp", "node"], "left")
            .select("grp", "node", "central", F.coalesce("now", "label").alias("label"), F.coalesce("pivot", "done").alias("done")),
            "state",
        )
    return links if links is not None else state.where("false").select(F.col("node").alias("a"), F.col("label").alias("b"))


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Words are runs of characters other than blanks and 0x09-0x0D after lower-casing A-Z. Two rows link
    when ``100 * intersection >= percent * union`` of their sets of ``size``-word shingles; component_id
    is the smallest doc_id of the rows reached. Null and empty texts have an empty set and link with
    nothing. Repeated rows and equal texts share one set. A row without doc_id gets the component of the
    rows with its very set, else null. Further columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(text.mapInArrow(_scan(size), "doc_id long, n long, counted long, node long"), "sets", TEXT_ROWS)
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("counted").alias("counted"))

    def gathered(given: DataFrame, choose, wanted: bool, named: bool = True) -> DataFrame:
        packed = given.mapInArrow(_packed(size, 8 * parts, choose, wanted, named), "bucket int, tokens binary, nodes binary")
        return packed.repartition(parts, "bucket").sortWithinPartitions("bucket")

    counted = gathered(text.select("text"), lambda tokens: tokens[tokens < _LIMIT], False)
    shared = counted.mapInArrow(_held, "node long, n long").groupBy("node").agg(F.sum("n").alias("shared"))
    own = F.col("counted") - F.coalesce("shared", F.lit(0))
    spare = F.col("n") - F.ceil(F.col("n") * percent / 100)
    able = materialize(nodes.join(shared, "node", "left").where((own <= spare) & F.col("doc_id").isNotNull()).select("doc_id", "node", "n"), "able")
    listed = F.broadcast(able) if able.count() <= BROADCAST_MEMBERS else able
    standing = text.join(listed, "doc_id").select("text", "node")
    often = gathered(standing, lambda tokens: tokens, True, named=False).mapInArrow(_common, "token long, n long")
    top = often.orderBy(F.desc("n"), "token").limit(COMMON_TOKENS).select("token").toPandas()["token"].to_numpy(np.int64)
    common = spark.sparkContext.broadcast(np.sort(top.view(np.uint64)))
    keys = gathered(standing, lambda tokens: group_keys(tokens, common.value, percent), True)
    groups = connected_components(keys.mapInArrow(_shared, "a long, b long"))
    grouped = able.join(groups, "node")
    total = grouped.groupBy("label").agg(F.sum("n").alias("total"))
    members = materialize(
        grouped.join(total, "label").select("doc_id", "node", F.col("label").alias("grp"), (F.col("total") > TASK_TOKENS).alias("large")), "members"
    )
    few = members.count() <= BROADCAST_MEMBERS

    def token_sets(chosen: DataFrame) -> DataFrame:
        return text.join(F.broadcast(chosen) if few else chosen, "doc_id").mapInArrow(_member_tokens(size), "grp long, node long, tokens binary")

    small = token_sets(members.where("not large")).repartition(parts, "grp").sortWithinPartitions("grp")
    links = small.mapInArrow(_open_groups(percent), "a long, b long")
    if not members.where("large").isEmpty():
        large = token_sets(members.where("large")).dropDuplicates(["grp", "node"])
        links = links.union(_large_links(materialize(large, "large"), percent))
    label = connected_components(links)
    named = nodes.join(label, "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    found = named.join(least, "label").select("node", "component_id")
    return rows.join(found, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` less all but one of each component: the one with the smallest doc_id stays.

    Rows that repeat a doc_id are one document, of which one row stays. Rows without doc_id stay. Columns
    are those of ``docs``.
    """
    found = materialize(jaccard_components(docs, size, percent), "components")
    dropped = found.where("doc_id is not null").groupBy("doc_id").agg(F.min((F.col("doc_id") != F.col("component_id")).cast("int")).alias("gone"), F.count("*").alias("rows"))
    dropped = materialize(dropped.where("gone = 1 or rows > 1").select(F.col("doc_id").alias("_doc_id"), "gone"), "dropped")
    listed = F.broadcast(dropped) if dropped.count() <= BROADCAST_MEMBERS else dropped
    key = docs["doc_id"].cast("long") == F.col("_doc_id")
    single = docs.join(listed, key, "left_anti")
    repeated = docs.join(listed.where("gone = 0"), key, "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = repeated.groupBy("doc_id").agg(F.first(whole).alias("_row")).select("_row.*")
    return single.unionByName(once)
