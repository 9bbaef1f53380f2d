"""What data and queries tell about tables that nobody has documented: keys, roles, column use."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType

from tablehaul.session import saved

#: A column refers to a key when the key's table has all its values and this share of the key's
#: values is used. Sketches may miss by a tenth, so they are asked for less.
COVERAGE = 0.8
SLACK = 0.9

FOREIGN_KEY = "child_table string, child_column string, parent_table string, parent_column string"


def _family(kind: DataType) -> str | None:
    """Types whose values may be keys and can be compared."""
    return "integer" if isinstance(kind, IntegralType) else "text" if isinstance(kind, StringType) else None


def signatures(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, family, filled, sketch`` of all columns that may be keys.

    One scan per table; a column becomes a theta sketch of bounded size, which merges like a sum.
    """
    parts = []
    for name, df in tables.items():
        columns = [(f.name, _family(f.dataType)) for f in df.schema.fields if _family(f.dataType)]
        if not columns:
            continue
        found = df.agg(*[
            F.struct(
                F.lit(c).alias("column_name"), F.lit(family).alias("family"), F.count(F.col(c)).alias("filled"),
                F.theta_sketch_agg(F.col(c).cast("long" if family == "integer" else "string")).alias("sketch"),
            ).alias(f"_{i}")
            for i, (c, family) in enumerate(columns)
        ])
        listed = F.explode(F.array(*[F.col(f"_{i}") for i in range(len(columns))])).alias("s")
        parts.append(found.select(F.lit(name).alias("table_name"), listed).select("table_name", "s.*"))
    return reduce(DataFrame.unionByName, parts)


def candidate_keys(known: DataFrame) -> DataFrame:
    """Pairs of columns that may be child and parent, from signatures alone (``FOREIGN_KEY``)."""
    sized = known.withColumn("distinct", F.theta_sketch_estimate("sketch")).filter("filled > 0")
    names = {"table_name": "table", "column_name": "column"}
    child = sized.select("family", *[F.col(c).alias(f"child_{n}") for c, n in names.items()],
                         F.col("sketch").alias("_c"), F.col("distinct").alias("_nc"))
    parent = sized.filter(F.col("distinct") >= F.col("filled") * SLACK).select(
        "family", *[F.col(c).alias(f"parent_{n}") for c, n in names.items()],
        F.col("sketch").alias("_p"), F.col("distinct").alias("_np"),
    )
    both = F.theta_sketch_estimate(F.theta_intersection("_c", "_p"))
    return child.join(parent, "family").filter("child_table <> parent_table").withColumn("_both", both).filter(
        (F.col("_both") >= F.col("_nc") * SLACK) & (F.col("_both") >= F.col("_np") * COVERAGE * SLACK)
    ).select("child_table", "child_column", "parent_table", "parent_column")


def _exact(tables: dict[str, DataFrame], pair) -> DataFrame:
    """Counts of one pair, from the distinct values of both sides."""
    def values(side: str) -> DataFrame:
        column = F.col(pair[f"{side}_column"])
        kind = "string" if _family(tables[pair[f"{side}_table"]].schema[pair[f"{side}_column"]].dataType) == "text" else "long"
        return tables[pair[f"{side}_table"]].groupBy(column.cast(kind).alias("k")).agg(
            F.count(F.lit(1)).alias(f"{side}_n")
        ).filter("k IS NOT NULL")

    return values("child").join(values("parent"), "k", "full").agg(
        *[F.lit(pair[c]).alias(c) for c in ("child_table", "child_column", "parent_table", "parent_column")],
        F.count("child_n").alias("children"), F.count("parent_n").alias("parents"),
        F.count_if(F.col("child_n").isNotNull() & F.col("parent_n").isNotNull()).alias("shared"),
        F.max("child_n").alias("most_children"), F.max("parent_n").alias("most_parents"),
    )


def foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """The key that each column refers to: ``FOREIGN_KEY, coverage, child_role, parent_role``.

    All pairs of columns of comparable types are candidates; sketches rule out nearly all, and
    the rest are checked exactly. A column refers to a unique column of another table that has
    all its values, to the one of which it uses the largest share (ties by name). A column that
    is unique itself does so only if it uses all. Roles: a ``fact`` refers to others, a
    ``dimension`` is referred to, ``both`` do both.
    """
    found = candidate_keys(saved(signatures(tables), "signatures")).collect()  # names only
    if not found:
        return tables[next(iter(tables))].sparkSession.createDataFrame(
            [], f"{FOREIGN_KEY}, coverage double, child_role string, parent_role string"
        )
    checked = saved(reduce(DataFrame.unionByName, [_exact(tables, p) for p in found]), "exact-keys")
    coverage = F.col("shared") / F.col("parents")
    holds = (
        (F.col("shared") == F.col("children")) & (F.col("most_parents") == 1) & (coverage >= COVERAGE)
        & ((F.col("most_children") > 1) | (F.col("shared") == F.col("parents")))
    )
    best = checked.filter(holds).groupBy("child_table", "child_column").agg(F.min(F.struct(
        (-coverage).alias("less"), "parent_table", "parent_column"
    )).alias("b")).select(
        "child_table", "child_column", "b.parent_table", "b.parent_column",
        F.round(-F.col("b.less"), 6).alias("coverage"),
    )
    best = saved(best, "foreign-keys")
    refers = best.select(F.col("child_table").alias("t")).distinct().withColumn("refers", F.lit(True))
    referred = best.select(F.col("parent_table").alias("t")).distinct().withColumn("referred", F.lit(True))
    role = F.when(F.col("refers") & F.col("referred"), "both").when(F.col("refers"), "fact").otherwise("dimension")
    roles = refers.join(referred, "t", "full").select("t", role.alias("role"))
    for side in ("child", "parent"):
        own = roles.select(F.col("t").alias(f"_k_{side}_table"), F.col("role").alias(f"{side}_role"))
        best = best.join(own, F.col(f"{side}_table") == F.col(f"_k_{side}_table")).drop(f"_k_{side}_table")
    return best


# ---- column use ------------------------------------------------------------------------------


def _items(seq) -> Iterator:
    each = seq.iterator()
    while each.hasNext():
        yield each.next()


def _references(expression) -> list[int]:
    return [a.exprId().id() for a in _items(expression.references())]


def plan_column_use(df: DataFrame) -> Counter:
    """How often a query uses stored columns in filters, joins and groups: (column, role).

    The analysed plan is walked from the scans up; a computed column stands for the stored ones
    it is made of. Nothing is run.
    """
    stored: dict[int, frozenset[str]] = {}
    used: Counter = Counter()

    def origins(ids: Iterable[int]) -> set[str]:
        return set().union(*(stored.get(i, frozenset()) for i in ids))

    def note(expression, role: str) -> None:
        for name in origins(_references(expression)):
            used[name, role] += 1

    def walk(node) -> None:
        for child in _items(node.children()):
            walk(child)
        name = node.nodeName()
        if name.startswith("Relation") or "LogicalRelation" in node.getClass().getSimpleName():
            for a in _items(node.output()):
                stored[a.exprId().id()] = frozenset([a.name()])
        elif name == "Filter":
            note(node.condition(), "filter")
        elif name == "Join" and node.condition().isDefined():
            note(node.condition().get(), "join")
        elif name == "Aggregate":
            for e in _items(node.groupingExpressions()):
                note(e, "group")
        listed = {"Project": "projectList", "Aggregate": "aggregateExpressions", "Window": "windowExpressions"}
        if name in listed:
            for e in _items(getattr(node, listed[name])()):
                own = e.toAttribute().exprId().id()
                if own not in stored:
                    stored[own] = frozenset(origins(_references(e)))

    walk(df._jdf.queryExecution().analyzed())
    return used


def column_use(queries: Iterable[DataFrame], table: DataFrame) -> DataFrame:
    """``column_name, filters, joins, groups`` of a table's columns that a workload uses.

    Counts queries, each at most once per role. Columns are known by name, so names of different
    tables have to differ where both occur.
    """
    counts: Counter = Counter()
    for df in queries:
        counts.update(plan_column_use(df).keys())
    rows = [
        (c, counts[c, "filter"], counts[c, "join"], counts[c, "group"]) for c in table.columns
        if any(counts[c, role] for role in ("filter", "join", "group"))
    ]
    return table.sparkSession.createDataFrame(rows, "column_name string, filters long, joins long, groups long")
