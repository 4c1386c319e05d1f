"""N-gram Jaccard join by a token-group matrix.

1. Documents become sets of hashed word shingles. Two sets of the wanted similarity
   share one of the first few shingles of each (its prefix) in any common order.
   Only sets that share a prefix shingle with another are candidates. The order puts
   shingles that a sample of documents shows to be frequent last; it decides how much
   is compared, never what is found.
2. Equal sets are one class. Classes of the same least shingle are a group, of
   bounded size, and each group stores the union of its members' shingles.
3. Groups that share a prefix shingle meet. A member can only link into a group if
   enough of its shingles lie in the group's union; only groups for which that bound
   holds are opened, and their members' overlaps counted.
4. In a first round each shingle's groups meet its first group only. Groups that are
   wholly in one component by then need not meet; a second round compares the rest.
   So a large family of copies costs as many comparisons as it has groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import done_with, lower_ascii, small_batches, written
from docmill.llm.components import connected_components, with_least
from docmill.llm.levels import KeyTable
from docmill.llm.shingles import mixed, runs, word_hashes

SHINGLE = 5
PERCENT = 80
#: Prefixes are longer than need be by one shingle in so many, and as many more must be shared.
EXTEND = 20
#: Members of a group.
GROUP = 256
#: One document in so many tells which shingles are frequent, by occurring so often;
#: at most so many of them are told apart (the broadcast's bound).
SAMPLE_ONE_IN = 16
FREQUENT = 4
MAX_FREQUENT = 1 << 20
_COLUMNS = 8192


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashed shingles, ascending; fewer words than one form one."""
    own = word_hashes(lower_ascii(text))
    if len(own) < shingle:
        return runs(own, len(own), len(own)) if len(own) else own
    return np.unique(runs(own, shingle))


def _set_name(tokens: np.ndarray) -> str | None:
    return xxhash.xxh3_128_hexdigest(tokens.tobytes()) if len(tokens) else None


def set_ids(text: Column, shingle: int = SHINGLE) -> Column:
    """The set_id that ``jaccard_components`` gives a row with this text."""

    def names(texts: pd.Series) -> pd.Series:
        return pd.Series([_set_name(shingle_set(t, shingle)) for t in texts], dtype=object)

    return F.pandas_udf(names, "string")(text)


def least_shared(n: int) -> int:
    """How many shingles the prefix of a set of size n has beyond the shortest one, plus
    one: two similar sets share at least as many prefix shingles as the smaller has."""
    return 1 + n // EXTEND


def prefix(tokens: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first shingles in the common order: frequent ones last, else by hash. Of the
    shingles that two similar sets share, the first ``least_shared`` are in both prefixes."""
    n = len(tokens)
    length = n - -(-percent * n // 100) + least_shared(n) if n else 0
    if len(frequent) and n:
        at = np.searchsorted(frequent, tokens)
        late = frequent[np.minimum(at, len(frequent) - 1)] == tokens
        tokens = np.concatenate([tokens[~late], tokens[late]])
    return tokens[:length]


def enough_shared(n: int, shared: int, percent: int = PERCENT) -> bool:
    """Whether a set of size n, of whose prefix ``shared`` shingles occur elsewhere, may be
    similar to another: the smallest such set has ``percent`` of its size."""
    return shared >= least_shared(-(-percent * n // 100))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    if not len(both):
        return out
    sides = []
    for sets, tokens in ((left, a), (right, b)):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(both, tokens), len(both) - 1)
        hit = both[at] == tokens
        sides.append((owner[hit], at[hit]))
    for start in range(0, len(both), _COLUMNS):
        blocks = []
        for (owner, at), n in zip(sides, out.shape, strict=True):
            here = (at >= start) & (at < start + _COLUMNS)
            block = np.zeros((n, min(_COLUMNS, len(both) - start)), dtype=np.float32)
            block[owner[here], at[here] - start] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out


def links(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs are similar enough: 100 * intersection >= percent * union."""
    shared = overlaps(left, right).astype(np.int64)
    sizes = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
    return 100 * shared >= percent * (sizes - shared)


def _spread(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a bipartite link matrix, as (left, right) numbers."""
    left_done, right_done = np.zeros(linked.shape[0], bool), np.zeros(linked.shape[1], bool)
    x, y = [], []
    for i in np.nonzero(linked.any(axis=1))[0]:
        if left_done[i]:
            continue
        todo = [(int(i), True)]
        left_done[i] = True
        while todo:
            k, is_left = todo.pop()
            if is_left:
                new = np.nonzero(linked[k] & ~right_done)[0]
                right_done[new] = True
                x += [k] * len(new)
                y += new.tolist()
            else:
                new = np.nonzero(linked[:, k] & ~left_done)[0]
                left_done[new] = True
                x += new.tolist()
                y += [k] * len(new)
            todo += [(int(j), not is_left) for j in new]
    return np.array(x, dtype=np.int64), np.array(y, dtype=np.int64)


def _sets(blobs) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype=np.uint64) for b in blobs]


def _frequent(docs: DataFrame, shingle: int) -> np.ndarray:
    """Frequent shingles of the sampled documents, ascending; bounded in number."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in small_batches(batches, "_text"):
            found = [shingle_set(t, shingle) for t in batch["_text"]]
            yield pd.DataFrame({"_t": np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)})

    sample = docs.filter(F.pmod(F.xxhash64("_key"), F.lit(SAMPLE_ONE_IN)) == 0)
    counts = sample.select("_text").mapInPandas(emit, "_t long").groupBy("_t").count()
    top = counts.filter(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "_t").limit(MAX_FREQUENT)
    return np.sort(top.toPandas()["_t"].to_numpy(np.int64).view(np.uint64))


def _shared_tokens(docs: DataFrame, frequent: np.ndarray, shingle: int, percent: int) -> KeyTable:
    """The prefix shingles that occur in two documents."""
    late = docs.sparkSession.sparkContext.broadcast(frequent)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in small_batches(batches, "_text"):
            found = [prefix(shingle_set(t, shingle), late.value, percent) for t in batch["_text"]]
            keys = np.repeat(batch["_key"].to_numpy(np.int64), [len(x) for x in found])
            tokens = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
            yield pd.DataFrame({"_t": tokens, "_key": keys})

    rows = docs.select("_key", "_text").mapInPandas(emit, "_t long, _key long")
    ends = rows.groupBy("_t").agg(F.min("_key").alias("lo"), F.max("_key").alias("hi"))
    return KeyTable(ends.filter("lo < hi"), "_t", "shared-tokens")


def _document_sets(
    docs: DataFrame, shared: KeyTable, frequent: np.ndarray, shingle: int, percent: int
) -> DataFrame:
    """(_id, _n, _set, _least, _shared, _tokens): the last three null if no candidate."""
    id_type = docs.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, _n long, _set string, _least long, _shared array<long>, _tokens binary"
    late = docs.sparkSession.sparkContext.broadcast(frequent)
    names = ["_n", "_set", "_least", "_shared", "_tokens"]

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in small_batches(batches, "_text"):
            sets = [shingle_set(t, shingle) for t in batch["_text"]]
            heads = [prefix(s, late.value, percent) for s in sets]
            found = shared.contains(np.concatenate([*heads, np.zeros(0, np.uint64)]))
            begin, out = 0, []
            for tokens, head in zip(sets, heads, strict=True):
                marks = head[found[begin : begin + len(head)]]
                begin += len(head)
                blob = tokens.tobytes()
                name = _set_name(tokens)
                if len(tokens) and enough_shared(len(tokens), len(marks), percent):
                    least = int(mixed(tokens + np.uint64(1)).min().view(np.int64))
                    out.append((len(tokens), name, least, marks.view(np.int64), blob))
                else:
                    out.append((len(tokens), name, None, None, None))
            frame = pd.DataFrame(out, columns=names).astype({"_least": "Int64"})
            yield pd.concat([batch[["_id"]].reset_index(drop=True), frame], axis=1)

    return docs.select("_id", "_text").mapInPandas(emit, schema)


def _groups(classes: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """(_g, _names, _sets, _union, _shared, _low, _high, _need): groups of classes with the
    same least shingle, of about ``size`` members. The union of a single member is its
    set: null. _low and _high bound the members' sizes; a similar set of another group
    shares at least _need prefix shingles with a member."""
    counts = sets.filter("_tokens IS NOT NULL").groupBy("_least").count().filter(F.col("count") > size)
    parts = written(counts.select("_least", F.ceil(F.col("count") / size).alias("_parts")), "group-parts")
    dealt = classes.join(parts, "_least", "left").withColumn(
        "_part", F.expr("pmod(xxhash64(_set), coalesce(_parts, 1))")
    )

    members = F.sort_array(F.collect_list(F.struct("_set", "_tokens", "_shared")))  # at most about size
    packed = dealt.groupBy("_least", "_part").agg(members.alias("_m"))
    named = packed.select(F.concat_ws("/", "_least", "_part").alias("_g"), "_m")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for members in batch["_m"]:
                blobs = [m["_tokens"] for m in members]
                sizes = [len(b) // 8 for b in blobs]
                union = np.unique(np.concatenate(_sets(blobs))).tobytes() if len(blobs) > 1 else None
                shared = sorted({int(t) for m in members for t in m["_shared"]})
                need = min(least_shared(-(-percent * n // 100)) for n in sizes)
                names = [m["_set"] for m in members]
                out.append((names, blobs, union, shared, min(sizes), max(sizes), need))
            frame = pd.DataFrame(out, columns=["_names", "_sets", "_union", "_shared", "_low", "_high", "_need"])
            yield pd.concat([batch[["_g"]].reset_index(drop=True), frame], axis=1)

    schema = (
        "_g string, _names array<string>, _sets array<binary>, _union binary, _shared array<long>,"
        " _low long, _high long, _need long"
    )
    return named.mapInPandas(pack, schema)


_EDGES = "a string, b string"


def _forest_edges(x: np.ndarray, y: np.ndarray, left, right) -> pd.DataFrame:
    a, b = np.array(left, dtype=object)[x], np.array(right, dtype=object)[y]
    return pd.DataFrame({"a": a, "b": b})


def _inner_links(groups: DataFrame, percent: int) -> DataFrame:
    """Links within groups, as forests."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for names, blobs in zip(batch["_names"], batch["_sets"], strict=True):
                if len(names) > 1:
                    sets = _sets(blobs)
                    x, y = _spread(links(sets, sets, percent))
                    yield _forest_edges(x, y, names, names)

    return groups.select("_names", "_sets").mapInPandas(emit, _EDGES).filter("a <> b")


def _outer_links(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links between the paired groups (a, b), as forests: first the bound of a's members
    on b's union, then, of the pairs that pass it, the members of both."""
    left = groups.select(F.col("_g").alias("a"), F.col("_names").alias("_names_a"), F.col("_sets").alias("_sets_a"))
    unions = groups.select(F.col("_g").alias("b"), F.coalesce("_union", F.col("_sets")[0]).alias("_union"))

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for blobs, union in zip(batch["_sets_a"], batch["_union"], strict=True):
                union = np.frombuffer(union, dtype=np.uint64)
                sets = _sets(blobs)
                tokens = np.concatenate(sets)
                at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
                within = np.add.reduceat(union[at] == tokens, np.cumsum([0, *[len(s) for s in sets[:-1]]]))
                need = percent * np.array([len(s) for s in sets])
                keep.append(bool((100 * within >= need).any()))
            yield batch.loc[keep, ["a", "b"]]

    open_ = pairs.join(left.select("a", "_sets_a"), "a").join(unions, "b")
    # Written, so that no task holds the Python workers of both steps, with their sets, at once.
    qualified = written(open_.select("a", "b", "_sets_a", "_union").mapInPandas(bound, _EDGES), "open-pairs")
    right = groups.select(F.col("_g").alias("b"), F.col("_names").alias("_names_b"), F.col("_sets").alias("_sets_b"))
    opened = qualified.join(left, "a").join(right, "b")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                x, y = _spread(links(_sets(row["_sets_a"]), _sets(row["_sets_b"]), percent))
                if len(x):
                    yield _forest_edges(x, y, row["_names_a"], row["_names_b"])

    names = ["_names_a", "_sets_a", "_names_b", "_sets_b"]
    return opened.select(*names).mapInPandas(compare, _EDGES)


def _meeting(asked: DataFrame, left: DataFrame, percent: int) -> DataFrame:
    """(a, b) of those rows of ``left`` (shingle _t, group a) and ``asked`` that share enough
    prefix shingles and whose sizes allow a link."""
    right = asked.select("_t", *[F.col(c).alias(f"{c}_b") for c in asked.columns if c != "_t"])
    size_fits = f"100 * _high_b >= {percent} * _low AND 100 * _high >= {percent} * _low_b"
    pairs = left.join(right, "_t").filter(f"_g < _g_b AND _label <> _label_b AND {size_fits}")
    counted = pairs.groupBy("_g", "_g_b").agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.greatest("_need", "_need_b")).alias("_least")
    )
    return counted.filter("_n >= _least").select(F.col("_g").alias("a"), F.col("_g_b").alias("b"))


def _components(classes: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """(_set, root) for classes that link with another."""
    groups = written(_groups(classes, sets, size, percent), "token-groups")
    traits = ["_g", "_low", "_high", "_need"]
    asked = groups.select(*traits, F.col("_g").alias("_label"), F.explode("_shared").alias("_t"))
    first = asked.groupBy("_t").agg(F.min("_g").alias("_g"), F.max("_g").alias("_z")).filter("_g < _z")
    hubs = asked.join(first.select("_t", "_g"), ["_t", "_g"])
    stars = written(_meeting(asked, hubs, percent), "group-pairs")
    found = written(_inner_links(groups, percent).unionByName(_outer_links(stars, groups, percent)), "set-links")
    roots = written(connected_components(found), "set-roots")
    # A group's component, or its own name where its members lie in several.
    member = groups.select("_g", F.explode("_names").alias("node")).join(roots, "node", "left")
    labels = member.groupBy("_g").agg(
        F.min(F.coalesce("root", "node")).alias("lo"), F.max(F.coalesce("root", "node")).alias("hi")
    )
    labels = labels.select("_g", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("_g")).alias("_label"))
    # Written, so that no plan holds a table, and all that it comes from, several times.
    labels = written(labels, "group-labels")
    labelled = asked.drop("_label").join(labels, "_g")
    ends = labelled.groupBy("_t").agg(F.min("_label").alias("lo"), F.max("_label").alias("hi"))
    several = written(labelled.join(ends.filter("lo < hi").select("_t"), "_t"), "several-labels")
    pairs = _meeting(several, several, percent).join(stars, ["a", "b"], "left_anti")
    pairs = written(pairs, "group-pairs")
    done_with(labels, several)
    more = _outer_links(pairs, groups, percent)
    return connected_components(written(found.unionByName(more), "set-links"))


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    group: int = GROUP,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id reachable by
    links of ``percent`` or more, its own included), set_id (documents of one class).

    Null texts and texts without words have empty sets and link with nothing. Rows
    that share an id are one document, which is not compared with itself; each has
    its own row. Rows without an id link like others, but name no component. Other
    columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    docs = docs.withColumn("_key", F.coalesce(F.col("_id").cast("long"), F.xxhash64("_text")))
    frequent = _frequent(docs, shingle)
    shared = _shared_tokens(docs, frequent, shingle, percent)
    sets = written(_document_sets(docs, shared, frequent, shingle, percent), "document-sets")
    classes = (
        sets.filter("_tokens IS NOT NULL")
        .groupBy("_set")
        .agg(
            F.any_value("_tokens").alias("_tokens"),
            F.any_value("_shared").alias("_shared"),
            F.any_value("_least").alias("_least"),
        )
    )
    roots = _components(classes, sets, group, percent)
    firsts = sets.filter("_set IS NOT NULL").groupBy("_set").agg(F.min("_id").alias("_first"))
    named = firsts.join(roots, F.col("node") == F.col("_set"), "left")
    rooted = written(named.select("_set", "_first", F.coalesce("root", "_set").alias("root")), "set-firsts")
    named = with_least(rooted, "root", "_set", "_first", "component_id")
    named = written(named.select("_set", "component_id"), "set-names")
    done_with(rooted)
    return sets.select("_id", "_n", "_set").join(named, "_set", "left").select(
        F.col("_id").alias(id_col),
        F.col("_n").alias("n_shingles"),
        F.coalesce("component_id", "_id").alias("component_id"),
        F.col("_set").alias("set_id"),
    )
