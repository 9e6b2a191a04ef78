"""Near-duplicate embeddings: sign hashing by random hyperplanes, exact cosines, components.

Equal vectors are one class. A class's signs before random hyperplanes give a code in each of
several tables; classes that share a code in some table are compared. What travels through the
tables is a class's number and its sketch, the codes of the first tables: two classes whose
sketches differ in too many signs for the threshold, or agree in the code of an earlier table,
need no look at their vectors. Vectors are sent only for classes with a partner left, and their
exact cosines decide. A large bucket is cut into tiles, and every pair of tiles is a group of
bounded size. A pair that shares several tables is counted in the first one, so neither pairs nor
links leave the tasks: each class sends the number of its links and the smallest class that it
reaches there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import persist_table
from meterwatch.llm.components import component_tops, connected_components

#: Rows of a bucket that are compared at once.
TILE = 1024
#: Classes that a bucket holds on average, and the chance to miss a pair just at the threshold in every table.
PER_BUCKET, MISS = 512, 1e-9
#: Numbers of a sketch and the bits used of each.
SKETCHES, SKETCH_BITS = 3, 63
SKETCH = [f"s{k}" for k in range(SKETCHES)]
#: Tables that the number of a bucket has room for.
TABLES = 1 << 14


def table_plan(classes: int, threshold: float) -> tuple[int, int]:
    """(bits of a code, tables): codes grow with the logarithm of the input, tables keep the chance of a miss."""
    bits = min(30, max(6, math.ceil(math.log2(max(classes, 1) / PER_BUCKET))))
    agree = 1 - math.acos(threshold) / math.pi
    while (tables := math.ceil(math.log(MISS) / math.log(1 - agree ** bits))) >= TABLES:
        bits -= 1  # a low threshold: larger buckets instead of more tables
    return bits, tables


def sketch_plan(bits: int, tables: int, threshold: float) -> tuple[int, int]:
    """(tables in a sketch, most signs that differ): a pair just at the threshold differs in more with a chance of at most MISS."""
    held = min(tables, SKETCHES * (SKETCH_BITS // bits))
    n, differ = held * bits, math.acos(threshold) / math.pi
    beyond, most = 0.0, n
    while most > 0:
        beyond += math.comb(n, most) * differ ** most * (1 - differ) ** (n - most)
        if beyond > MISS:
            break
        most -= 1
    return held, most


@lru_cache(maxsize=4)
def _planes(dims: int, n: int) -> np.ndarray:
    return np.random.default_rng(20_011 + dims).standard_normal((dims, n))


def _scaled(embeddings: np.ndarray) -> np.ndarray:
    """Vectors in double precision, each by the power of two that brings its largest entry near 1 (cosines stay the same)."""
    vectors = np.stack(embeddings).astype(np.float64)
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1))[1][:, None])


def _codes(classes: DataFrame, bits: int, tables: int, held: int) -> DataFrame:
    """class, n, embedding, codes (array<int>, one of each table), s0 to s2 (the codes of the first ``held`` tables)."""
    powers = 1 << np.arange(bits, dtype=np.int64)
    each = SKETCH_BITS // bits

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, same in b.groupby(b["embedding"].map(len)):
                vectors = _scaled(same["embedding"].to_numpy())
                signs = vectors @ _planes(vectors.shape[1], bits * tables) > 0
                codes = signs.reshape(len(same), tables, bits) @ powers
                sketch = np.zeros((SKETCHES, len(same)), np.int64)
                for t in range(held):
                    sketch[t // each] |= codes[:, t] << (t % each * bits)
                yield same.assign(codes=list(codes.astype(np.int32)), **dict(zip(SKETCH, sketch)))

    return classes.mapInPandas(run, f"class long, n long, embedding {classes.schema['embedding'].dataType.simpleString()}, "
                                    "codes array<int>, " + ", ".join(f"{s} long" for s in SKETCH))


def _sides(side: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray]:
    left = np.flatnonzero(side == 0)
    return left, left if within else np.flatnonzero(side == 1)


def _table_of(bucket: int) -> int:
    return bucket >> 30 & TABLES - 1


def _partners(groups, bits: int, held: int, most: int) -> DataFrame:
    """bucket, i, j, side, class of the rows of a group whose sketch leaves a partner in it."""
    each = SKETCH_BITS // bits
    schema = pa.schema([("bucket", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("side", pa.int32()), ("class", pa.int64())])

    def run(g: pa.Table) -> pa.Table:
        table = _table_of(g["bucket"][0].as_py())
        within = g["i"][0].as_py() == g["j"][0].as_py()
        left, right = _sides(g["side"].to_numpy(), within)
        sketch = [g[s].to_numpy() for s in SKETCH]
        apart = sum(np.bitwise_count(s[left][:, None] ^ s[right][None, :]) for s in sketch)
        a, b = np.nonzero(np.triu(apart <= most, 1) if within else apart <= most)
        a, b = left[a], right[b]
        for t in range(min(table, held)):
            if not len(a):
                break
            own = sketch[t // each] >> (t % each * bits) & ((1 << bits) - 1)
            new = own[a] != own[b]
            a, b = a[new], b[new]
        return g.take(np.unique(np.concatenate([a, b]))).select(schema.names).cast(schema)

    return groups.applyInArrow(run, "bucket long, i int, j int, side int, class long")


def _links(partners: DataFrame, threshold: float) -> DataFrame:
    """class, links, parent of the groups of tiles; rows: bucket, i, j, side, class, n, embedding, codes."""
    def compare(g: pd.DataFrame) -> pd.DataFrame:
        names, sizes = g["class"].to_numpy(), g["n"].to_numpy()
        vectors, codes = _scaled(g["embedding"].to_numpy()), np.stack(g["codes"].to_numpy(), axis=1)
        norms = np.sqrt((vectors * vectors).sum(1))
        within = g["i"].iat[0] == g["j"].iat[0]
        left, right = _sides(g["side"].to_numpy(), within)
        cosines = (vectors[left] @ vectors[right].T) / norms[left][:, None] / norms[right][None, :]
        a, b = np.nonzero(np.triu(cosines >= threshold, 1) if within else cosines >= threshold)
        a, b = left[a], right[b]
        for own in codes[:_table_of(int(g["bucket"].iat[0]))]:  # a table at a time: most pairs of a dense tile share one of the first
            if not len(a):
                break
            new = own[a] != own[b]
            a, b = a[new], b[new]
        links = np.bincount(a, sizes[b], len(names)) + np.bincount(b, sizes[a], len(names))
        parent = names.copy()
        while True:
            low = np.minimum(parent[a], parent[b])
            before = parent.copy()
            np.minimum.at(parent, a, low)
            np.minimum.at(parent, b, low)
            if (before == parent).all():
                break
        has = links > 0
        return pd.DataFrame({"class": names[has], "links": links[has].astype(np.int64), "parent": parent[has]})

    return partners.groupBy("bucket", "i", "j").applyInPandas(compare, "class long, links long, parent long")


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    Links are pairs with a cosine of ``threshold`` or more in double precision;
    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest id that links reach, and ``kept`` marks the row with that id. Vectors that are NULL, empty or zero, or hold NULL
    or non-finite numbers, and rows with a NULL id are linked with nothing; vectors
    of different lengths never link. Repeated rows count once and get the same
    result; rows that repeat an id with other vectors are compared like rows of
    their own, and of those that share a component's smallest id one is kept. A pair
    just at the threshold is missed twice in a thousand million times (no common code,
    or sketches too far apart), a closer one less often. Entries may have any magnitude. Runs jobs when called and writes intermediate tables.
    """
    embedding = F.col(vector_col)
    if vectors.select(embedding).schema[0].dataType.simpleString() != "array<float>":  # floats travel as they are, cosines are double
        embedding = embedding.cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), embedding.alias("embedding"))
    rows = rows.withColumns({"d1": F.xxhash64("embedding"), "d2": F.xxhash64(F.lit(7), "embedding")})
    sound = F.expr("""vec_id is not null and embedding is not null
        and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))
        and exists(embedding, x -> x <> 0)""")
    usable = rows.filter(sound)
    members = usable.select("vec_id", "d1", "d2").distinct()
    sizes = members.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min("vec_id").alias("vec_id"))
    one = usable.select("vec_id", "d1", "d2", "embedding").dropDuplicates(["vec_id", "d1", "d2"])
    # a class is a number that is written down
    classes = sizes.join(one, ["vec_id", "d1", "d2"]).select(
        F.monotonically_increasing_id().alias("class"), F.col("vec_id").alias("first_id"), "n", "embedding", "d1", "d2")
    classes = persist_table(classes)

    bits, tables = table_plan(classes.count(), threshold)
    held, most = sketch_plan(bits, tables, threshold)
    coded = persist_table(_codes(classes.select("class", "n", "embedding"), bits, tables, held))
    # one number names a bucket: length of the vectors, table, code
    placed = coded.select("class", *SKETCH, F.size("embedding").cast("long").alias("dims"), F.posexplode("codes").alias("table", "code")).select(
        "class", *SKETCH, F.expr("shiftleft(dims, 44) | shiftleft(cast(table as bigint), 30) | code").alias("bucket"))
    buckets = placed.groupBy("bucket").agg(F.count("*").alias("rows")).filter("rows > 1")
    dealt = placed.join(buckets, "bucket").withColumn("tiles", F.expr(f"cast(ceil(rows / {TILE}) as int)"))
    whole = dealt.filter("tiles = 1").select("bucket", *[F.lit(0).alias(c) for c in ("i", "j", "side")], "class", *SKETCH)
    cut = dealt.filter("tiles > 1").withColumn("own", F.expr("cast(pmod(xxhash64(class), tiles) as int)"))
    to = F.explode(F.expr("""concat(
        transform(sequence(own, tiles - 1), t -> struct(own as i, t as j, 0 as side)),
        transform(filter(sequence(0, tiles - 1), t -> t < own), t -> struct(t as i, own as j, 1 as side)))"""))
    cut = cut.select("bucket", "class", *SKETCH, to.alias("to")).select("bucket", "to.i", "to.j", "to.side", "class", *SKETCH)
    # a bucket that fits in a tile is compared where the join left it
    partners = persist_table(_partners(whole.groupBy("bucket"), bits, held, most).unionByName(
        _partners(cut.groupBy("bucket", "i", "j"), bits, held, most)))
    links = persist_table(_links(partners.join(coded.select("class", "n", "embedding", "codes"), "class"), threshold))
    found = connected_components(links.select(F.col("class").alias("a"), F.col("parent").alias("b")))
    counts = links.groupBy("class").agg(F.sum("links").alias("links"))

    firsts = classes.select("class", "first_id", F.struct("d1", "d2").alias("first_key"))
    known = classes.select("class", "first_id", "n", "d1", "d2").join(counts, "class", "left").join(
        component_tops(found, firsts), "class", "left")
    placed = members.join(known, ["d1", "d2"]).select(
        "vec_id", "d1", "d2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("top_id", "first_id").alias("top_id"),
        F.coalesce("top_key", F.struct("d1", "d2")).alias("top_key"))
    result = rows.drop("embedding").join(placed, ["vec_id", "d1", "d2"], "left")
    kept = (F.col("top_id") == F.col("vec_id")) & (F.col("top_key") == F.struct("d1", "d2"))
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("top_id", "vec_id").alias("component_id"),
                         F.coalesce(kept, F.lit(True)).alias("kept"))


SQL = """
with recursive v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
n as (select vec_id, e, sqrt(list_dot_product(e, e)) as s from v),
l as (select a.vec_id as x, b.vec_id as y from n a join n b on a.vec_id <> b.vec_id
      where list_dot_product(a.e, b.e) / a.s / b.s >= 0.95),
r as (select vec_id as x, vec_id as c from embeddings union select l.y, r.c from r join l on l.x = r.x where r.c < l.y),
k as (select x, min(c) as c from r group by x),
m as (select x, count(*) as n_links from l group by x)
select vec_id, coalesce(n_links, 0) as n_links, c as component_id, vec_id = c as kept
from embeddings join k on vec_id = k.x left join m on vec_id = m.x
"""
