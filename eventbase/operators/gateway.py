"""SQL over ingested tables, limited to the tables of the given application."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from eventbase.operators.keyed_table import KeyedTable
from eventbase.operators.registry import EventConfig
from eventbase.operators.store import EventStore
from eventbase.session import prepare


# Functions that call any static method of the driver's JVM.
_REFLECTION = ("reflect", "java_method", "try_reflect")
# Leaves of a plan that read nothing stored.
_STORELESS = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef", "EmptyRelation"}


def scoped_session(spark: SparkSession, views: dict[str, KeyedTable]) -> SparkSession:
    """A session whose only temporary views are the given tables."""
    session = prepare(spark.newSession())
    for name in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"):
        session.conf.set(name, spark.conf.get(name))
    # SELECT ... FROM parquet.`/any/path` would reach past the views.
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    functions = session._jsparkSession.sessionState().functionRegistry()
    for name in _REFLECTION:
        functions.dropFunction(session._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name))
    for name, table in views.items():
        KeyedTable(session, table.path).read().createOrReplaceTempView(f"`{name}`")
    return session


def _check_scope(df: DataFrame, tables: list[KeyedTable]) -> None:
    """Refuse a query that reads anything but the files of the given tables, subqueries included."""
    roots = [table.files.qualified(place) for table in tables for place in table.places()]
    plan = df._jdf.queryExecution().analyzed()
    below = plan.subqueriesAll()
    shared_views = f"SubqueryAlias {df.sparkSession.conf.get('spark.sql.globalTempDatabase', 'global_temp')}."
    for part in [plan, *(below.apply(i) for i in range(below.size()))]:
        if shared_views in part.treeString():
            raise PermissionError("not within the given tables: a global view")
        leaves = part.collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            kind = leaf.nodeName().split(" ")[0]
            if kind in _STORELESS:
                continue
            if kind != "LogicalRelation" and kind != "Relation":
                raise PermissionError(f"not within the given tables: {kind}")
            paths = leaf.relation().location().rootPaths()
            for path in (paths.apply(i).toString() for i in range(paths.size())):
                if not any(f"{path}/".startswith(f"{root}/") for root in roots):
                    raise PermissionError(f"not within the given tables: {path}")


def query(
    store: EventStore, app_key: str, event_types: str | Sequence[str], sql: str
) -> DataFrame:
    """Run a SELECT over the tables of one application.

    Each event type can be named by its table name or by its type alone. The statement is
    first analysed as a subquery: only a query can stand there, so commands are refused. Its plan may
    read the files of these tables alone: global views and catalog tables are refused, and functions that
    reach into the JVM are not there.
    """
    wanted = [event_types] if isinstance(event_types, str) else list(event_types)
    known: dict[str, EventConfig] = {c.event_type: c for c in store.configs() if c.app_key == app_key}
    missing = [e for e in wanted if e not in known]
    if missing:
        raise PermissionError(f"not registered for application {app_key!r}: {missing}")
    views = {}
    for event_type in wanted:
        table = store.table(known[event_type])
        if not table.exists():
            table = store.ready_table(known[event_type])
        views[known[event_type].table_name] = table
        views[event_type] = table
    session = scoped_session(store.spark, views)
    _check_scope(session.sql(f"SELECT * FROM (\n{sql}\n)"), list(views.values()))
    return session.sql(sql)


def publish_to_catalog(store: EventStore, config: EventConfig, name: str, copy: bool = True) -> None:
    """Make a table visible to every session of the Spark catalog, for analysis.

    As a copy of its current rows, or (``copy=False``) without one: as an external table over the files of the newest
    base, into which everything is folded first. Call it again to follow later changes.
    """
    table = store.table(config)
    if copy:
        table.read().write.mode("overwrite").saveAsTable(name)
        return
    table.rewrite()
    versions = set(table.state().base.values())
    if not versions:
        raise ValueError(f"{table.path} has no rows yet")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    store.spark.sql(f"DROP TABLE IF EXISTS {name}")
    location = f"{table.path}/base/{versions.pop()}"
    store.spark.sql(f"CREATE TABLE {name} ({columns}, `__bucket` int) USING parquet PARTITIONED BY (`__bucket`) LOCATION '{location}'")
    store.spark.sql(f"MSCK REPAIR TABLE {name}")


