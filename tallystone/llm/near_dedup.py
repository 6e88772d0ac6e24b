"""Near-duplicate documents: MinHash signatures joined through an inverted index of their coordinates."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tallystone.llm import set_links
from tallystone.llm.arrow_text import text_buffers
from tallystone.llm.components import connected_components
from tallystone.llm.words import mix, rows_of_words, shingle_hashes
from tallystone.llm.workers import map_in_arrow, per_group
from tallystone.sources.columns import quoted
from tallystone.sources.tables import stage

WORDS = 5
# Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
# Coordinates of a signature, and how many must agree. Two texts that are exactly 75 % alike agree in
# fewer than 20 of 48 with a probability below 1 in 100,000; such a pair alone would be lost.
COORDINATES = 48
MATCHES = 20

# Sets that are compared with each other by one task, at most, by number and by shingles.
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1 << 18
# Connected lists with more members than this in all are compared list by list.
CLUSTER_ROWS = 100_000

_random = np.random.Generator(np.random.PCG64(48_020))
_MULTIPLIERS = _random.integers(0, 2**64, 1024, dtype=np.uint64) | np.uint64(1)
_SALTS = _random.integers(0, 2**64, 1024, dtype=np.uint64)


def signature(shingles: np.ndarray, bounds: np.ndarray, coordinates: int) -> np.ndarray:
    """One row of coordinates per row of shingles (none may be empty); the coordinate's number is mixed in."""
    out = np.empty((len(bounds) - 1, coordinates), np.uint64)
    for j in range(coordinates):
        out[:, j] = np.minimum.reduceat(shingles * _MULTIPLIERS[j], bounds[:-1])
    return mix(out + _SALTS[:coordinates])


def _signatures(df: DataFrame, coordinates: int, words: int) -> DataFrame:
    """``doc_id, n, set_key, coords``: distinct shingles, a 128-bit hash of their set, the signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = len(batch)
            counts = np.zeros(rows, np.int64)
            keys: list[bytes | None] = [None] * rows
            coords = np.zeros((rows, coordinates), np.uint64)
            for first, hashes, firsts in rows_of_words(batch.column(1)):
                shingles, bounds = shingle_hashes(hashes, firsts, words)
                held = np.flatnonzero(np.diff(bounds))
                if not len(held):
                    continue
                coords[first + held] = signature(shingles, np.append(bounds[:-1][held], bounds[-1]), coordinates)
                for i in held.tolist():
                    distinct = np.unique(shingles[bounds[i] : bounds[i + 1]])
                    counts[first + i] = len(distinct)
                    keys[first + i] = _set_key(distinct)
            filled = counts > 0
            offsets = np.concatenate([[0], np.cumsum(filled * coordinates)]).astype(np.int32)
            values = pa.array(coords[filled].reshape(-1).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array(keys, pa.binary()), lists],
                names=["doc_id", "n", "set_key", "coords"],
            )

    return map_in_arrow(df, sign, "doc_id bigint, n bigint, set_key binary, coords array<bigint>")


def _set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles, digest_size=16).digest()


def _sets(df: DataFrame, words: int) -> DataFrame:
    """``set_key, members``: the distinct shingle hashes of a text, ascending, as bytes; equal sets once per task."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for _, hashes, firsts in rows_of_words(batch.column(0)):
                shingles, bounds = shingle_hashes(hashes, firsts, words)
                keys, members = [], []
                for i in range(len(bounds) - 1):
                    distinct = np.unique(shingles[bounds[i] : bounds[i + 1]])
                    key = _set_key(distinct)
                    if key not in seen:
                        seen.add(key)
                        keys.append(key)
                        members.append(distinct.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(members, pa.binary())], names=["set_key", "members"])

    return map_in_arrow(df.select("text"), gather, "set_key binary, members binary")


def _prefix_lists(nodes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """``token, node, n, common``: posting lists that are enough to find every pair with ``matches`` collisions.

    A token is a coordinate's number and value. Two signatures that share ``matches`` of their tokens
    share one among the ``coordinates - matches + 1`` rarest of either, whatever else they hold. Tokens
    in one signature only are the rarest of all and need no list, so a document without relatives has
    none. The commonest tokens, those of copied passages, are skipped as long as a document has enough
    others. ``common`` counts a node's tokens that are in other signatures, too.
    """
    postings = nodes.select("node", "n", F.explode("coords").alias("token"))
    shared = stage(postings.groupBy("token").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "token-sizes").df
    hits = postings.join(shared, "token")
    own = Window.partitionBy("node")
    place = F.row_number().over(own.orderBy("size", "token"))
    common = F.count(F.lit(1)).over(own)
    prefix = hits.withColumns({"_place": place, "common": common})
    prefix = prefix.filter(F.col("_place") <= F.col("common") + F.lit(1 - matches))
    prefix = stage(prefix.select("token", "node", "n", "common"), "prefixes").df
    several = prefix.groupBy("token").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("token")
    return stage(prefix.join(several, "token", "left_semi"), "posting-lists").df


def _link_blocks(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links between the sets of a pair of blocks; ``side`` is 0 or 1, or 2 where both are one block."""

    def link(table: pa.Table) -> pa.Table:
        sides = table.column("side").to_numpy()
        both = [_as_sets(table.filter(pa.array((sides == own) | (sides == 2)))) for own in (0, 1)]
        a, b = set_links.links(*both, percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return link


def _as_sets(table: pa.Table) -> set_links.Sets:
    members = pa.chunked_array([c.cast(pa.large_binary()) for c in table.column("members").chunks], pa.large_binary()).combine_chunks()
    members = members.chunk(0) if isinstance(members, pa.ChunkedArray) and members.num_chunks else members
    data, bounds = text_buffers(members.view(pa.large_string())) if len(members) else (np.empty(0, np.uint8), np.zeros(1, np.int64))
    values = data[bounds[0] : bounds[-1]].view(np.uint64)
    columns = [table.column(c).to_numpy() for c in ("node", "component", "n")]
    return set_links.Sets(*columns, values, (bounds - bounds[0]) // 8)


def _links_across_components(lists: DataFrame, components: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between nodes that share a list but no component, enough of them to connect what all would.

    In a list most members are often in one component already; lists within one need no look. The others
    are put together where they share components: sets that can be linked are in one such cluster then,
    and a set goes through the shuffle once, not once per list. Clusters are cut into blocks of
    bounded size, so that a task holds two blocks, however large a cluster is. Blocks hand out links only,
    fewer than they have members. A cluster beyond ``CLUSTER_ROWS`` is compared list by list instead.
    """
    placed = lists.join(components, "node", "left").select("token", "node", "n", F.coalesce("component", "node").alias("component"))
    placed = stage(placed, "placed").df
    spread = placed.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    mixed = placed.join(spread.filter("least < most").select("token", "least"), "token")
    mixed = stage(mixed, "mixed-lists").df
    clusters = connected_components(mixed.select(F.col("component").alias("a"), F.col("least").alias("b")))
    clusters = stage(clusters.select(F.col("node").alias("component"), F.col("component").alias("cluster")), "clusters").df
    members = stage(mixed.select("node", "n", "component").distinct().join(clusters, "component"), "cluster-members").df
    rows = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"))
    large = rows.filter(F.col("rows") > CLUSTER_ROWS).select("cluster")
    by_cluster = members.join(large, "cluster", "left_anti").select(F.lit(False).alias("is_list"), F.col("cluster").alias("part"), "node", "n", "component")
    by_list = mixed.join(clusters.join(large, "cluster", "left_semi").select("component"), "component", "left_semi")
    parted = by_cluster.union(by_list.select(F.lit(True), "token", "node", "n", "component"))

    sizes = parted.groupBy("is_list", "part").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("bigint")
    dealt = parted.join(sizes.select("is_list", "part", blocks.alias("blocks")), ["is_list", "part"])
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = dealt.withColumn("own", own).join(sets, "node")
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    met = met.withColumns(
        {
            "low": F.least("own", "other"),
            "high": F.greatest("own", "other"),
            "side": F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1),
        }
    )
    grouped = met.select("is_list", "part", "low", "high", "side", "node", "n", "component", "members").groupBy("is_list", "part", "low", "high")
    found = grouped.applyInArrow(per_group(lists.sparkSession, _link_blocks(percent)), "a bigint, b bigint")
    return stage(found, "links-across").df


def _enough_collisions(pairs: DataFrame, nodes: DataFrame, matches: int) -> DataFrame:
    """The pairs ``a, b`` whose signatures agree in at least ``matches`` coordinates."""
    left = nodes.select(F.col("node").alias("a"), F.col("coords").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("coords").alias("y"))
    same = F.aggregate(
        F.zip_with("x", "y", lambda p, q: (p == q).cast("int")), F.lit(0), lambda total, hit: total + hit
    )
    return pairs.join(left, "a").join(right, "b").filter(same >= matches).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are links by their full shingle sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            (x, x_ends), (y, y_ends) = (text_buffers(batch.column(c).cast(pa.large_binary()).view(pa.large_string())) for c in "xy")
            for i in range(len(batch)):
                p = x[x_ends[i] : x_ends[i + 1]].view(np.uint64)
                q = y[y_ends[i] : y_ends[i + 1]].view(np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                common = 0
                if len(p):
                    at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                    common = int(np.count_nonzero(q[at] == p))
                linked.append(common > 0 and 100 * common >= percent * (len(p) + len(q) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
    joined = stage(pairs, "candidates").df.join(left, "a").join(right, "b")
    return stage(map_in_arrow(joined, compare, "a bigint, b bigint"), "links").df


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = PERCENT,
    words: int = WORDS,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    1. Texts with equal shingle sets are one node, so copies cost nothing further.
    2. Signatures are posted under their rarest coordinate values (``_prefix_lists``).
    3. In every list the nodes of like size are compared with one of them only, the one that has most in
       common with others; the pairs that collide often enough are confirmed on full sets, and what is
       linked becomes one component.
    4. Nodes that share a list but no component are then compared on full sets, in blocks that hand out
       links only (``_links_across_components``). Pairs within a component need no comparison.

    Words are runs of other than ASCII white space, with A-Z in lower case; a text of fewer than
    ``words`` words is one shingle. Null, empty and blank texts have no shingle, link with nothing and
    are kept. A row with a null id links with nothing, has a null component, and is kept. Repeated rows
    are copies of each other: all of them carry the same id, so all are kept or none. Rows with one id
    and different texts are texts of their own, each with its links; the id stands for all of them where
    it names a component. Other columns are not read; an empty table gives an empty result.
    """
    documents = df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    signed = stage(_signatures(documents, coordinates, words), "signatures").df
    known = signed.filter("n > 0 and doc_id is not null")
    # Numbers for the distinct sets: once written, they stay what they are.
    first = known.groupBy("set_key").agg(F.min("doc_id").alias("first"), F.any_value("n").alias("n"), F.any_value("coords").alias("coords"))
    classes = stage(first.withColumn("node", F.monotonically_increasing_id()), "classes").df

    lists = _prefix_lists(classes.select("node", "n", "coords"), coordinates, matches)
    listed = stage(classes.join(lists.select("node").distinct(), "node", "left_semi"), "listed").df
    nodes = listed.select("node", "coords")
    # The ids alone pick the texts, as they are the least that can be broadcast; sets then find their numbers by key.
    ids = stage(listed.select(F.col("first").alias("doc_id")).distinct(), "listed-ids").df
    gathered = _sets(documents.join(ids, "doc_id", "left_semi"), words).dropDuplicates(["set_key"])
    sets = stage(gathered.join(listed.select("set_key", "node"), "set_key").select("node", "members"), "shingle-sets").df

    # Nodes in one class of size differ by less than the percentage allows. Of these the one with most
    # common tokens has the least of its own, so it is the likeliest to be near all the others.
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))
    sized = lists.withColumn("size_class", size_class)
    best = sized.groupBy("token", "size_class").agg(F.max(F.struct("common", (-F.col("node")).alias("id"))).alias("best"))
    best = best.select("token", "size_class", (-F.col("best.id")).alias("center"))
    stars = sized.join(best, ["token", "size_class"]).filter("node <> center")
    stars = stars.select(F.greatest("node", "center").alias("a"), F.least("node", "center").alias("b")).distinct()
    links = _confirmed(_enough_collisions(stars, nodes, matches), sets, percent)

    components = stage(connected_components(links, most_rounds=2), "first-components").df
    more = _links_across_components(lists, components, sets, percent)
    components = stage(connected_components(links.union(more)), "components").df

    # A component is named by its smallest id. A class's component first, so the join with the documents is
    # the only one over all of them.
    firsts = classes.select("node", "set_key", "first")
    names = components.join(firsts, "node").groupBy("component").agg(F.min("first").alias("name"))
    ended = firsts.join(components.join(names, "component").select("node", "name"), "node", "left")
    ended = ended.select("set_key", F.coalesce("name", "first").alias("component"))
    rows = signed.select("doc_id", F.col("n").alias("n_shingles"), "set_key")
    rows = rows.join(ended, "set_key", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    found = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _is_ordered(kind: T.DataType) -> bool:
    """Whether values of a type can be compared."""
    if isinstance(kind, T.StructType):
        return all(_is_ordered(f.dataType) for f in kind.fields)
    return _is_ordered(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def without_near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, with one document of each group of near duplicates, the smallest id.

    Repeated rows of one id and text become one row, the one with the least other columns (in their order,
    those whose type has none left out). Rows with a null id link with nothing and stay.
    """
    found = near_duplicates(df, id_column, text_column).filter("kept and doc_id is not null")
    kept = found.select(F.col("doc_id").alias("_kept")).distinct()
    key, others = [quoted(id_column), quoted(text_column)], [f for f in df.schema.fields if f.name not in (id_column, text_column)]
    named = df.filter(key[0].isNotNull()).join(kept, key[0].cast("bigint") == F.col("_kept"), "left_semi")
    row = F.struct(*[quoted(f.name) for f in others], F.lit(0).alias("_end"))
    rank = F.struct(*[quoted(f.name) for f in others if _is_ordered(f.dataType)], F.lit(0).alias("_end"))
    single = named.groupBy(key[0].alias("_id"), key[1].alias("_text")).agg(F.min_by(row, rank).alias("_row"))
    columns = {id_column: F.col("_id"), text_column: F.col("_text")} | {f.name: F.col("_row")[f.name] for f in others}
    return single.select(*[columns[name].alias(name) for name in df.columns]).union(df.filter(key[0].isNull()))
