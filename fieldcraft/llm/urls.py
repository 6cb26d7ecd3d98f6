"""URL filters: rules on hosts and path prefixes, by a sort-merge range join.

A host is written label by label from its end (``com.example.www``), followed by
``?`` (which neither a host nor a path holds) and the path. In that canonical
form a rule is a prefix, hence an interval of the sorted keys, and two such
intervals are nested or apart. A url gets one point per ancestor of its host
(``com``, ``com.example``, ...), since a rule fits its host and all subdomains;
points and rules are range-partitioned and sorted together, and one sweep per
partition keeps the stack of the rules that are open at the current key: its top
is the longest rule of that ancestor. The longest over a url's ancestors wins
(by the characters of host and path, then of the host).

A rule may stay open past the end of its partition. Every partition hands its
first key and its open rules (at most one per nesting level) to the driver,
which passes each rule on to the partitions that begin inside it; only points
that met no rule of their own partition look at those.

Scale: narrow rows only, never the page. Ancestors deeper than the deepest rule
host are not made, paths are compared up to the longest rule path (both exact),
and points whose ancestor is no rule host are dropped by a bitmap of fixed size.
Points are ordered by key and row, so a url that makes up a third of all rows
spreads over many partitions. The rules are never broadcast.

Cases: a null url or one without ``://`` has an empty host and path; a rule whose
host or verdict is null is no rule, a null rule path is empty; of equal rules the
largest verdict counts (``block`` over ``allow``); urls that no rule fits get
``default``; urls of any length are read whole; repeated rows and null ids are
judged separately; empty tables give empty results or no rules; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcraft.llm.membership import flag_likely
from fieldcraft.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: kinds of swept rows: a point, the first key of a partition, a rule open at its end
POINT, FIRST, OPEN = 0, 1, 2
SWEPT = "kind int, part int, row long, key string, rule string, verdict string, host_chars int"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, "\\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("?"), path)


def canonical_rules(rules: DataFrame) -> DataFrame:
    """``key, anchor, depth, path_chars, rule, verdict, host_chars``, one row per
    different (host, path) of ``rules(host, path, verdict)``."""
    host = F.translate("host", UPPER, LOWER)
    rows = (rules.filter("host IS NOT NULL AND verdict IS NOT NULL")
            .select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    labels = _labels(F.col("host"))
    return rows.select(_key(labels, F.col("path")).alias("key"), F.array_join(labels, ".").alias("anchor"),
                       F.size(labels).alias("depth"), F.length("path").alias("path_chars"),
                       F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_chars"))


def sweep(rows):
    """Sorted ``(key, point row or None, rule...)`` -> ``(point, key, open rule or
    None)`` per point; the generator's value is the stack left at the end."""
    stack: list[tuple] = []
    for key, row, rule in rows:
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        if row is None:
            stack.append((key, rule))
        else:
            yield row, key, stack[-1][1] if stack else None
    return stack


def _sweep_partition(batches):
    import pyarrow as pa
    from pyspark import TaskContext
    names = [f.split()[0] for f in SWEPT.split(", ")]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32()]
    part = TaskContext.get().partitionId()
    first: list[str] = []
    left: list[tuple] = []

    def rows():
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("key", "row", "rule", "verdict", "host_chars")]
            for key, row, rule, verdict, chars in zip(*cols):
                if not first:
                    first.append(key)
                yield key, row, (rule, verdict, chars)

    def swept():
        left.extend((yield from sweep(rows())))

    def record(out):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    out = []
    for row, key, rule in swept():
        out.append((POINT, part, row, *((None, *rule) if rule else (key, None, None, None))))
        if len(out) == 10_000:
            yield record(out)
            out = []
    out += [(FIRST, part, None, k, None, None, None) for k in first]
    out += [(OPEN, part, None, key, *rule) for key, rule in left]
    if out:
        yield record(out)


def carried(edges: list[tuple]) -> list[tuple]:
    """From ``(part, kind, key, rule...)`` of the partitions' edges: the rules
    open at the beginning of each partition, as ``(part, key, rule...)``."""
    first = {e[0]: e[2] for e in edges if e[1] == FIRST}
    opened: dict[int, list[tuple]] = {}
    for e in edges:
        if e[1] == OPEN:
            opened.setdefault(e[0], []).append(tuple(e[2:]))
    out, stack = [], []
    for part in sorted(first):
        stack = [r for r in stack if first[part].startswith(r[0])]
        out += [(part, *r) for r in stack]
        stack += opened.get(part, [])
    return out


def matches(points: DataFrame, rules: DataFrame) -> DataFrame:
    """``points(row, key)`` x canonical rules -> ``row, rule, verdict,
    host_chars``: the longest rule that is a prefix of each point's key."""
    spark = points.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (rules.select("key", F.lit(None).cast("long").alias("row"), "rule", "verdict", "host_chars")
            .unionByName(points.select("key", "row"), allowMissingColumns=True))
    order = [F.col("key"), F.col("row").asc_nulls_first()]  # a rule opens before the points at its key
    swept = materialize(rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
                        .mapInArrow(_sweep_partition, SWEPT), "urls")
    found = swept.filter("kind = 0 AND rule IS NOT NULL").select("row", "rule", "verdict", "host_chars")
    # one key and the nested open rules of every partition
    edges = swept.filter("kind > 0").select("part", "kind", "key", "rule", "verdict", "host_chars").collect()
    carry = carried([tuple(e) for e in edges])
    if not carry:
        return found
    table = F.broadcast(spark.createDataFrame(
        carry, "part int, prefix string, rule string, verdict string, host_chars int"))
    late = (swept.filter("kind = 0 AND rule IS NULL").select("part", "row", "key").join(table, "part")
            .filter(F.startswith("key", "prefix")).select("row", "rule", "verdict", "host_chars"))
    return found.unionByName(late)


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row of ``pages``, by
    ``rules(host, path, verdict)``."""
    host, path = host_and_path(F.col(f"`{url_col}`"))
    base = materialize(pages.select(F.monotonically_increasing_id().alias("row"),
                                    F.col(f"`{id_col}`").cast("long").alias("page_id"),
                                    host.alias("host"), path.alias("path")), "hosts")
    rules = materialize(canonical_rules(rules), "rules")
    limits = rules.agg(F.max("depth").alias("depth"), F.max("path_chars").alias("chars")).first()
    if limits["depth"] is None:
        return base.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    points = (base.withColumn("labels", _labels(F.col("host")))
              .select("row", "path", "labels", F.explode(F.sequence(
                  F.lit(1), F.least(F.size("labels"), F.lit(limits["depth"])))).alias("k"))
              .select("row", F.substring("path", 1, limits["chars"]).alias("path"),
                      F.array_join(F.slice("labels", F.lit(1), F.col("k")), ".").alias("anchor")))
    points = flag_likely(points, F.col("anchor"), rules.select("anchor").distinct()).filter("__likely")
    points = points.select("row", F.concat("anchor", F.lit("?"), F.col("path")).alias("key"))
    best = (matches(points, rules).groupBy("row")
            .agg(F.max(F.struct(F.length("rule"), "host_chars", "rule", "verdict")).alias("won")))
    return (base.join(best, "row", "left")
            .select("page_id", "host", "path", F.col("won.rule").alias("rule"),
                    F.coalesce("won.verdict", F.lit(default)).alias("verdict")))
