"""Shards of near equal bytes by minimax contiguous partition.

Documents with equal texts form a group that is never split, groups stand in the order of their digests, and
a shard is a run of them. The smallest capacity with which the runs fit is found by binary search, each trial
filling shards greedily; the cuts then lie as near to even as that capacity lets them.

Groups are never gathered. The search sees units, runs of groups whose digests start alike, and after every search
those units that any cut of that capacity or a smaller one could lie in are split further, until each is one
group. So the capacity is the smallest one over groups, while the search holds about a hundred thousand sums at
any size of the corpus. Only Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lotkeeper.session import written

SHARDS = 16
#: Hexadecimal digits of the digest that a unit has at first, and those added where units are split.
DIGITS, MORE = 4, 2
#: Steps that find a place among the prefix sums, and a capacity.
_PLACES, _HALVINGS = 24, 64


def _find(x: str) -> str:
    """The last place whose prefix sum is at most x."""
    middle = "cast((a.l + a.h + 1) div 2 as int)"
    return (f"aggregate(sequence(1, {_PLACES}), named_struct('l', 0, 'h', n), (a, i) -> if(a.l < a.h, if(p[{middle}] <= {x}, "
            f"named_struct('l', {middle}, 'h', a.h), named_struct('l', a.l, 'h', {middle} - 1)), a), a -> a.l)")


def _cut(units: DataFrame, shards: int) -> DataFrame:
    """One row: prefix sums p and keys of the units in order, the smallest capacity, and the places of the cuts."""
    order = Window.orderBy("key")
    sums = units.select("key", F.sum("size").over(order).alias("p"))
    one = sums.agg(F.array_sort(F.collect_list(F.struct("p", "key"))).alias("u")).selectExpr(
        "transform(u, x -> x.key) AS keys", "concat(array(0L), transform(u, x -> x.p)) AS p", "size(u) AS n")
    fill = f"aggregate(sequence(1, {shards}), 0, (at, k) -> {_find('p[at] + c')}) >= n"
    tried = f"aggregate(array((s.l + s.h) div 2), false, (b, c) -> {fill})"
    search = (f"aggregate(sequence(1, {_HALVINGS}), named_struct('l', p[n] div {shards}, 'h', p[n]), (s, j) -> if(s.l < s.h, if({tried}, "
              "named_struct('l', s.l, 'h', (s.l + s.h) div 2), named_struct('l', (s.l + s.h) div 2 + 1, 'h', s.h)), s), s -> s.h)")
    found = one.withColumn("capacity", F.expr(search))
    # the first place from which the rest fits into what is left of the shards, for each cut from the last one back
    before = _find("p[at[0]] - capacity - 1")
    fits = f"if(p[at[0]] <= capacity, 0, {before} + 1)"
    found = found.withColumn("earliest", F.expr(
        f"aggregate(sequence(1, {shards - 1}), array(n), (at, k) -> concat(array({fits}), at))") if shards > 1 else F.expr("array(n)"))
    even = f"cast(p[n] as decimal(38, 0)) * k div {shards}"
    near = f"aggregate(array({_find(even)}), 0, (b, j) -> if(j < n AND p[least(j + 1, n)] - {even} < {even} - p[j], j + 1, j))"
    reach = _find("p[element_at(cuts, -1)] + capacity")
    return found.withColumn("cuts", F.expr(
        f"aggregate(sequence(1, {shards - 1}), array(0), (cuts, k) -> concat(cuts, array("
        f"least(greatest({near}, earliest[k - 1]), {reach}))))") if shards > 1 else F.expr("array(0)"))


def _giants(sized: DataFrame, units: DataFrame, shards: int) -> DataFrame:
    """Groups that hold no less than an even share of what larger ones leave: (digest, size, place).

    While k shards are left, a unit larger than such a group holds an even share as well, so at most k
    units without one come before it: all are among the 2 k largest units.
    """
    largest = units.orderBy(F.desc("size"), "key").limit(2 * shards).select(F.col("key").alias("unit"))
    groups = (sized.join(F.broadcast(largest), "unit", "left_semi").groupBy("digest").agg(F.sum("size").alias("size"))
              .orderBy(F.desc("size"), "digest").limit(shards))
    order = Window.orderBy(F.desc("size"), "digest")
    rest = F.lit(units.agg(F.sum("size")).first()[0]) - F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = (groups.withColumn("place", F.row_number().over(order) - 1)
              .withColumn("large", F.col("size") * (shards - F.col("place")) >= rest))
    return ranked.withColumn("large", F.min("large").over(order)).where("large").select("digest", "size", "place")


def shard(documents: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The shard of every document, and its place there.

    A document's size is the UTF-8 bytes of its text plus 1; null texts count as empty ones and are of one group with
    them. Groups of equal texts stay whole: one that holds an even share or more of what is left has a shard for itself,
    from the last one down, and the others are cut into runs. Rows stand in a shard by digest, hash of the id and
    id; rows with the same id and text are alike and take the places one after the other, null ids come first. An
    empty table gives no rows; with fewer groups than shards some shards stay empty. Returns the id, size,
    text_crc32, law (``bytes``), shard, slot and grown_shard (null: no other number of shards is promised anything).
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sized = written(documents.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), F.md5(text.cast("binary")).alias("digest"))
        .withColumn("unit", F.substring("digest", 1, DIGITS)), "sizes")
    summed = [F.sum("size").alias("size"), F.min("digest").alias("low"), F.max("digest").alias("high")]
    whole = written(sized.groupBy(F.col("unit").alias("key")).agg(*summed), "units")
    giants = written(_giants(sized, whole, shards), "giants")
    runs = shards - giants.count()
    others = sized.join(F.broadcast(giants.select("digest")), "digest", "left_anti") if runs < shards else sized
    units = whole if runs == shards else written(others.groupBy(F.col("unit").alias("key")).agg(*summed), "units")
    digits, cut = DIGITS, None
    while runs > 0:
        cut = written(_cut(units, runs), "cuts")
        # a cut after k shards leaves at most k capacities before it and runs - k after it
        at = cut.selectExpr("capacity", "p[n] AS total", "inline(transform(keys, (x, j) -> named_struct('key', x, 'l', p[j], 'h', p[j + 1])))").selectExpr(
            "key", f"exists(sequence(1, {runs}), k -> k < {runs} AND h > total - ({runs} - k) * capacity AND l < k * capacity) AS open")
        open_units = units.join(at.where("open"), "key", "left_semi").where("low <> high").select("key")
        open_units = written(open_units, "open-units")
        if open_units.isEmpty():
            break
        digits += MORE
        split = (others.join(F.broadcast(open_units.withColumn("unit", F.substring("key", 1, DIGITS))), "unit")
                 .where(F.col("digest").startswith(F.col("key"))).groupBy(F.substring("digest", 1, digits).alias("key")).agg(*summed))
        units = written(units.join(F.broadcast(open_units), "key", "left_anti").unionByName(split), "units")
    return _placed(sized, giants, cut, shards, id_col)


def _placed(sized: DataFrame, giants: DataFrame, cut: DataFrame | None, shards: int, id_col: str) -> DataFrame:
    spread = F.substring(F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary")), 1, 2)
    rows = sized.groupBy("unit", "digest", spread.alias("sub"), "_id", "size", "crc").agg(F.count("*").alias("copies"))
    # one row of at most as many starts as there are shards; none where giants are all there is
    starts = ([r["starts"] for r in cut.selectExpr(
        "transform(slice(cuts, 2, size(cuts)), c -> if(c < n, keys[c], 'g')) AS starts").collect()] if cut is not None else [])
    run = sum((F.when(F.col("digest") >= F.lit(key), 1).otherwise(0) for key in (starts[0] if starts else [])), F.lit(0))
    own = giants.select("digest", (F.lit(shards - 1) - F.col("place")).cast("int").alias("own"))
    rows = rows.join(F.broadcast(own), "digest", "left").withColumn("shard", F.coalesce("own", run).cast("int"))
    rows = written(rows.drop("own"), "rows")
    cell = ["shard", "unit", "sub"]
    cells = rows.groupBy(*cell).agg(F.sum("copies").alias("held"))
    earlier = Window.partitionBy("shard").orderBy("unit", "sub").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0))).drop("held")
    within = Window.partitionBy(*cell).orderBy("digest", F.col("_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("at", F.coalesce(F.sum("copies").over(within), F.lit(0))).join(cells, cell)
              .withColumn("first", F.col("at") + F.col("before")))
    slot = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)).alias("slot")
    return placed.select(F.col("_id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                         slot, F.lit(None).cast("int").alias("grown_shard"))


def crc32_sql(text: str, table: str = "crc_table") -> str:
    """CRC-32 of the UTF-8 bytes of a text, in SQL, with the 256 remainders in a list."""
    bytes_ = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return (f"xor(list_reduce({bytes_}, lambda a, b: xor(a >> 8, {table}[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)")


CRC_TABLE_SQL = ("list_transform(range(256), lambda c: list_reduce(range(8), lambda a, i: "
                 "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, c::BIGINT))")


def shard_sql(source: str = "documents", shards: int = SHARDS) -> str:
    """The same shards in SQL, searched over the groups themselves."""
    k = shards
    return f"""
WITH RECURSIVE crc AS (SELECT {CRC_TABLE_SQL} AS crc_table),
sized AS (SELECT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS digest, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size FROM {source}),
texts AS (SELECT digest, any_value(t) AS t, sum(size)::BIGINT AS size FROM sized GROUP BY 1),
crcs AS (SELECT digest, size, {crc32_sql('t')} AS crc FROM texts, crc),
ranked AS (SELECT *, row_number() OVER o - 1 AS place, sum(size) OVER () - coalesce(sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM crcs WINDOW o AS (ORDER BY size DESC, digest)),
marked AS (SELECT *, bool_and(place < {k} AND size * ({k} - place) >= rest) OVER (ORDER BY place) AS giant FROM ranked),
others AS (SELECT digest, size, sum(size) OVER (ORDER BY digest)::BIGINT AS p, row_number() OVER (ORDER BY digest) AS j FROM marked WHERE NOT giant),
lists AS (SELECT list_prepend(0::BIGINT, list(p ORDER BY j)::BIGINT[]) AS p, count(*) AS n, max(p)::BIGINT AS total,
  {k} - (SELECT count(*) FROM marked WHERE giant) AS k FROM others),
search AS (SELECT total // k AS l, total AS h, 0 AS step FROM lists WHERE n > 0 UNION ALL
  SELECT CASE WHEN fits THEN l ELSE m + 1 END, CASE WHEN fits THEN m ELSE h END, step + 1 FROM (
    SELECT l, h, step, (l + h) // 2 AS m, list_reduce(range(k), lambda a, i: list_max(list_filter(p, lambda x: x <= a + (l + h) // 2)), 0::BIGINT) >= total AS fits
    FROM search, lists WHERE l < h)),
capacity AS (SELECT h AS c FROM search ORDER BY step DESC LIMIT 1),
earliest AS (SELECT k AS shard, total AS p FROM lists WHERE n > 0 UNION ALL
  SELECT shard - 1, CASE WHEN e.p <= c THEN 0 ELSE (SELECT min(o.p) FROM others o WHERE o.p >= e.p - c) END::BIGINT FROM earliest e, capacity WHERE shard > 1),
cuts AS (SELECT 0 AS shard, 0::BIGINT AS p UNION ALL
  SELECT u.shard + 1, least(greatest((SELECT arg_min(o.p, (abs(o.p * k - total::HUGEINT * (u.shard + 1)), o.p)) FROM (SELECT p FROM others UNION ALL SELECT 0) o),
      (SELECT e.p FROM earliest e WHERE e.shard = u.shard + 1)), (SELECT max(o.p) FROM (SELECT p FROM others UNION ALL SELECT 0) o WHERE o.p <= u.p + c))::BIGINT
  FROM cuts u, capacity, lists WHERE u.shard + 1 < k),
dealt AS (SELECT digest, (SELECT count(*) FROM cuts WHERE cuts.shard > 0 AND cuts.p <= others.p - others.size) AS shard FROM others
  UNION ALL SELECT digest, {k} - 1 - place FROM marked WHERE giant)
SELECT doc_id, s.size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard, row_number() OVER (PARTITION BY shard ORDER BY substr(digest, 1, {DIGITS}),
    substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2), digest, doc_id NULLS FIRST) - 1 AS slot, NULL::INT AS grown_shard
FROM sized s JOIN crcs USING (digest) JOIN dealt USING (digest)"""
