"""Evidence as a graph of hashes: artifacts name others by name and hash, up to a root.

An artifact's hash covers its content and the names and hashes of all that it
names. It is worked out from the leaves up: every round hashes the artifacts
whose children are all done, and tells their parents. What is never done lies
in a cycle, or above one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.plans.registry import query
from tidemark.sources.journal import JOURNAL_SQL, journal
from tidemark.sources.staging import staged

#: Hexadecimal digits of a child's hashed name that make its bucket. Children are digested by bucket first, so an
#: artifact that names most of the others is not listed in one row.
BUCKET = 3

#: What is wrong with a root, by flags of all that it reaches; missing artifacts alone can still arrive.
GRAPH_REASONS: R.Rules = (("ROOT_MANIFEST_MISSING", "absent"), ("EVIDENCE_CYCLE", "NOT absent AND found IS NULL"), ("DECLARED_ARTIFACT_MISSING", "missing"), ("ARTIFACT_HASH_MISMATCH", "altered OR found <> declared"))
GRAPH_STATUS: R.Rules = (("INCOMPLETE", "absent"), ("CORRUPT", "found IS NULL OR altered OR found <> declared"), ("INCOMPLETE", "missing"))


#: Lines of an artifact up to which they are digested where they meet; those of one with more meet bucket by bucket first.
MANY = 4096


def _folded(lines: DataFrame) -> DataFrame:
    """(name, digest, missing, altered) of parents all of whose children there are have a hash.

    The digest is of the lines ``child:hash`` in the order of the children, by bucket and then over buckets.
    """
    text = lambda field, *by: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*by, field))), lambda x: x[field]), "\n")
    line = F.concat_ws(":", "child", F.coalesce(_text("found"), "declared", F.lit("")))
    entries = lines.select("parent", "child", line.alias("line"), "missing", "altered", "open", F.substring(F.sha2("child", 256), 1, BUCKET).alias("bucket"))
    flags = (F.bool_or("missing").alias("missing"), F.bool_or("altered").alias("altered"), F.bool_or("open").alias("open"))
    buckets = entries.groupBy("parent", "bucket").agg(F.sha2(text("line", "child"), 256).alias("part"), *flags)
    return buckets.groupBy(F.col("parent").alias("name")).agg(F.sha2(text("part", "bucket"), 256).alias("digest"), *flags).where("NOT open").drop("open")


def _digested(lines: DataFrame, large: DataFrame) -> DataFrame:
    """As ``_folded``; lines of a parent are shuffled once, unless it is one of the ``large`` ones, which are few."""
    large = F.broadcast(large)
    few = lines.join(large, "parent", "left_anti").repartition("parent")
    return _folded(few).unionAll(_folded(lines.join(large, "parent", "left_semi")))


def _text(hashed: str) -> Column:
    """A hash as text; on their way hashes are binary, which is half as long."""
    return F.lower(F.hex(hashed))


def _shelf(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(name, content, own, lines): nodes that name others with their content and how many they name, others with their hash."""
    parents = edges.groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("lines"))
    content = F.coalesce("content", F.lit(""))
    told = nodes.join(parents, "name", "left")
    return staged(told.select("name", F.when(F.col("lines").isNotNull(), content).alias("content"), F.when(F.col("lines").isNull(), F.unhex(F.sha2(content, 256))).alias("own"), "lines"))


@dataclass(frozen=True)
class Rehashed:
    """The ``shelf`` of all nodes, what was hashed of those that name others, and the edges to hashed children with their hashes."""

    shelf: DataFrame
    done: DataFrame
    edges: DataFrame


def rehashed(nodes: DataFrame, edges: DataFrame) -> Rehashed:
    """The work of ``rehash``. Contents are shuffled once, and so is an edge, by its child and then by its parent, until its parent has a hash.

    A round takes the lines of parents that wait for a child. It is written, and the driver learns only whether it was empty.
    """
    shelf = _shelf(nodes, edges)
    inner = shelf.where("own IS NULL").select("name", "content")
    large = shelf.where(F.col("lines") > MANY).select(F.col("name").alias("parent"))

    def met(lines: DataFrame, below: DataFrame, number: int) -> DataFrame:
        """Lines with the hashes of children in ``below``: (child, own, lost, changed, there)."""
        altered = F.coalesce("changed", F.lit(False)) | F.coalesce(_text("own") != F.col("declared"), F.lit(False))
        return lines.join(below, "child", "left").select(
            "parent", "child", F.col("own").alias("found"), F.when(F.col("own").isNull(), F.col("declared")).alias("declared"), F.coalesce("lost", F.col("there").isNull()).alias("missing"),
            altered.alias("altered"), (F.col("there").isNotNull() & F.col("own").isNull()).alias("open"), F.lit(number).alias("round"),
        )

    leaves = shelf.select(F.col("name").alias("child"), "own", F.lit(None).cast("boolean").alias("lost"), F.lit(None).cast("boolean").alias("changed"), F.lit(True).alias("there"))
    lines = staged(met(edges, leaves, 0))
    rounds, done = [lines], []
    while True:
        own = inner.join(_digested(lines, large), "name")
        done.append(staged(own.select("name", F.lit(len(rounds)).alias("height"), F.unhex(F.sha2(F.concat_ws("\n", "content", "digest"), 256)).alias("found"), "missing", "altered")))
        if done[-1].isEmpty():
            break
        waiting = lines.where("open")
        below = done[-1].select(F.col("name").alias("child"), F.col("found").alias("own"), F.col("missing").alias("lost"), F.col("altered").alias("changed"))
        # what is open is there
        now = met(waiting.select("parent", "child", "declared", F.lit(True).alias("there")), below, len(rounds))
        known = lines.where("NOT open").join(waiting.select("parent").distinct(), "parent", "left_semi")
        lines = staged(now.unionByName(known))
        if lines.isEmpty():
            break
        rounds.append(lines)
    found = [x.where(F.col("found").isNotNull() & (F.col("round") == i)).select("parent", "child", _text("found").alias("declared")) for i, x in enumerate(rounds)]
    return Rehashed(shelf, reduce(DataFrame.unionAll, done), reduce(DataFrame.unionAll, found))


def rehash(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(name, height, found, missing, altered) of every node that lies in no cycle and above none.

    ``nodes`` are (name, content), names once each; ``edges`` (parent, child,
    declared), where declared is the hash that the parent expects, or null. A
    child that is not there counts with its declared hash. missing and altered
    say whether any artifact below is not there, or has another hash than the
    one declared.
    """
    all_ = rehashed(nodes, edges)
    leaves = all_.shelf.where("own IS NOT NULL").select("name", F.lit(0).alias("height"), F.col("own").alias("found"), F.lit(False).alias("missing"), F.lit(False).alias("altered"))
    return leaves.unionAll(all_.done).withColumn("found", _text("found"))


def sealed(edges: DataFrame, hashed: DataFrame) -> DataFrame:
    """(parent, child, declared): edges with the hashes that ``rehash`` found for their children, as a writer seals them."""
    return edges.join(hashed.select(F.col("name").alias("child"), F.col("found").alias("declared")), "child").select("parent", "child", "declared")


def root_status(roots: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(name, status, reasons, height) of the roots (name, declared): COMPLETE, INCOMPLETE or CORRUPT, with all that speaks against them."""
    all_ = rehashed(nodes, edges)
    told = roots.join(all_.shelf.select("name", "own", F.lit(False).alias("absent")), "name", "left").join(all_.done.withColumn("found", _text("found")), "name", "left")
    leaf = F.col("own").isNotNull()
    told = told.select(
        "name", "declared", F.coalesce("absent", F.lit(True)).alias("absent"), F.coalesce("found", _text("own")).alias("found"), F.coalesce("height", F.when(leaf, 0)).alias("height"),
        F.coalesce("missing", F.when(leaf, False)).alias("missing"), F.coalesce("altered", F.when(leaf, False)).alias("altered"),
    )
    return told.select("name", R.first(GRAPH_STATUS, "COMPLETE").alias("status"), R.reasons(GRAPH_REASONS).alias("reasons"), "height")


#: The journal's evidence: events, orders of events, an asset's candidate bundle of orders, the barrier evaluation that
#: names the bundle, and a root manifest that names both.
def _name(kind: str, column: str) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.col(column).cast("string"))


def evidence_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of journal rows with an order, as they are written."""
    order, asset = _name("o", "order_hash"), _name("c", "token_id")
    own = rows.where("order_hash IS NOT NULL")
    events = own.select(_name("e", "event_id").alias("name"), F.concat_ws("|", "event_type", F.col("event_ms").cast("string"), "seller", "price_raw").alias("content"))
    orders = staged(own.groupBy("order_hash", "token_id").agg(F.count(F.lit(1)).alias("n")))
    assets = staged(own.groupBy("token_id").agg(F.max("event_ms").alias("ms")))
    text = lambda kind, value: F.concat(F.lit(f"{kind} "), F.col(value).cast("string")).alias("content")
    nodes = reduce(DataFrame.unionAll, [
        events, orders.select(order.alias("name"), text("order", "n")), assets.select(asset.alias("name"), text("bundle", "token_id")),
        assets.select(_name("b", "token_id").alias("name"), text("barrier", "ms")), assets.select(_name("r", "token_id").alias("name"), text("root", "token_id")),
    ])
    link = lambda parent, child: (parent.alias("parent"), child.alias("child"))
    edges = reduce(DataFrame.unionAll, [
        own.select(*link(order, _name("e", "event_id"))), orders.select(*link(asset, order)), assets.select(*link(_name("b", "token_id"), asset)),
        assets.select(*link(_name("r", "token_id"), asset)), assets.select(*link(_name("r", "token_id"), _name("b", "token_id"))),
    ])
    return nodes, edges


#: What happened to the written evidence since: lost and altered artifacts, and orders that name the root above them.
LOST = "(name LIKE 'e:%' AND TRY_CAST(substr(name, 3) AS BIGINT) % 1009 = 3) OR (name LIKE 'b:%' AND TRY_CAST(substr(name, 3) AS BIGINT) % 31 = 7) OR (name LIKE 'r:%' AND TRY_CAST(substr(name, 3) AS BIGINT) % 43 = 9)"
ALTERED = "(name LIKE 'e:%' AND TRY_CAST(substr(name, 3) AS BIGINT) % 1013 = 5) OR (name LIKE 'c:%' AND TRY_CAST(substr(name, 3) AS BIGINT) % 37 = 6)"
LOOPED = "length(token_id) > 1 AND CAST(token_id AS BIGINT) % 41 = 8 AND order_hash LIKE '%-2'"

_NODE_HASH = "sha256(coalesce(content, '') || coalesce(chr(10) || digest, ''))"


def _rehash_sql(name: str, nodes: str, edges: str) -> str:
    """Recursive: each step has all nodes of the step before, and those whose children these are."""
    lines = f"""SELECT e.parent, e.child, coalesce(r.found, e.declared, '') AS hash, coalesce(r.missing, true) AS missing, coalesce(r.altered OR r.found <> e.declared, false) AS altered
      FROM {edges} e LEFT JOIN {{r}} r ON r.name = e.child"""
    level = lambda r, ready: f"""SELECT name, content, sha256(string_agg(part, chr(10) ORDER BY bucket)) AS digest, bool_or(missing) AS missing, bool_or(altered) AS altered FROM (
      SELECT n.name, n.content, substr(sha256(l.child), 1, {BUCKET}) AS bucket, sha256(string_agg(l.child || ':' || l.hash, chr(10) ORDER BY l.child)) AS part, bool_or(l.missing) AS missing, bool_or(l.altered) AS altered
      FROM {nodes} n JOIN ({lines.format(r=r)}) l ON l.parent = n.name WHERE {ready} GROUP BY n.name, n.content, bucket) GROUP BY name, content"""  # noqa: E731
    nothing = "(SELECT NULL AS name, NULL AS found, NULL AS missing, NULL AS altered WHERE false)"
    return f"""{name}_open AS MATERIALIZED (SELECT e.parent, count(*) AS n FROM {edges} e WHERE e.child IN (SELECT name FROM {nodes}) GROUP BY e.parent),
{name}_all AS (
  SELECT 0 AS step, 0 AS height, name, {_NODE_HASH} AS found, missing, altered FROM ({level(nothing, f'n.name NOT IN (SELECT parent FROM {name}_open)')})
  UNION ALL SELECT 0, 0, name, sha256(coalesce(content, '')), false, false FROM {nodes} WHERE name NOT IN (SELECT parent FROM {edges})
  UNION ALL (WITH r AS (SELECT * FROM {name}_all),
    full_ AS (SELECT e.parent FROM {edges} e JOIN r ON r.name = e.child JOIN {name}_open o ON o.parent = e.parent GROUP BY e.parent, o.n HAVING count(*) = o.n)
    SELECT step + 1, height, name, found, missing, altered FROM r WHERE step < 6
    UNION ALL SELECT (SELECT max(step) FROM r) + 1, (SELECT max(step) FROM r) + 1, name, {_NODE_HASH}, missing, altered
    FROM ({level('r', 'n.name IN (SELECT parent FROM full_) AND n.name NOT IN (SELECT name FROM r)')}) WHERE (SELECT max(step) FROM r) < 6)),
{name} AS MATERIALIZED (SELECT height, name, found, missing, altered FROM {name}_all WHERE step = 6)"""


GRAPH_SQL = JOURNAL_SQL.replace("WITH base", "WITH RECURSIVE base") + f""", own AS (SELECT * FROM j WHERE order_hash IS NOT NULL),
nodes AS MATERIALIZED (
  SELECT 'e:' || event_id AS name, concat_ws('|', event_type, CAST(event_ms AS VARCHAR), seller, price_raw) AS content FROM own
  UNION ALL SELECT 'o:' || order_hash, 'order ' || count(*) FROM own GROUP BY order_hash, token_id
  UNION ALL SELECT 'c:' || token_id, 'bundle ' || token_id FROM own GROUP BY token_id
  UNION ALL SELECT 'b:' || token_id, 'barrier ' || max(event_ms) FROM own GROUP BY token_id
  UNION ALL SELECT 'r:' || token_id, 'root ' || token_id FROM own GROUP BY token_id),
edges AS MATERIALIZED (
  SELECT 'o:' || order_hash AS parent, 'e:' || event_id AS child, NULL AS declared FROM own
  UNION ALL SELECT DISTINCT 'c:' || token_id, 'o:' || order_hash, NULL FROM own
  UNION ALL SELECT DISTINCT 'b:' || token_id, 'c:' || token_id, NULL FROM own
  UNION ALL SELECT DISTINCT 'r:' || token_id, 'c:' || token_id, NULL FROM own
  UNION ALL SELECT DISTINCT 'r:' || token_id, 'b:' || token_id, NULL FROM own),
{_rehash_sql('written', 'nodes', 'edges')},
kept AS MATERIALIZED (SELECT name, CASE WHEN {ALTERED} THEN content || '!' ELSE content END AS content FROM nodes WHERE NOT ({LOST})),
sealed AS MATERIALIZED (SELECT e.parent, e.child, w.found AS declared FROM edges e JOIN written w ON w.name = e.child
  UNION ALL SELECT DISTINCT 'o:' || order_hash, 'r:' || token_id, NULL FROM own WHERE {LOOPED}),
{_rehash_sql('read_', 'kept', 'sealed')},
roots AS (SELECT w.name, w.found AS declared, k.name IS NULL AS absent, r.found, r.missing, r.altered, r.height FROM written w LEFT JOIN kept k USING (name) LEFT JOIN read_ r USING (name) WHERE w.name LIKE 'r:%')"""


@query("evidence_graph", GRAPH_SQL + f" SELECT name, {R.first_text(GRAPH_STATUS, 'COMPLETE')} AS status, {R.reasons_text(GRAPH_REASONS)} AS reasons, height FROM roots")
def evidence_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every asset's evidence, after some of it was lost, altered, or bent into a circle."""
    rows = journal(spark, sf_dir)
    nodes, edges = evidence_of(rows)
    written = rehashed(nodes, edges.withColumn("declared", F.lit(None).cast("string")))
    loops = rows.where("order_hash IS NOT NULL").where(LOOPED).select(_name("o", "order_hash").alias("parent"), _name("r", "token_id").alias("child"), F.lit(None).cast("string").alias("declared")).distinct()
    kept = nodes.where(f"NOT ({LOST})").withColumn("content", F.when(F.expr(ALTERED), F.concat("content", F.lit("!"))).otherwise(F.col("content")))
    roots = written.done.where("name LIKE 'r:%'").select("name", _text("found").alias("declared"))
    return root_status(roots, kept, written.edges.unionAll(loops))
