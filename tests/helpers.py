"""Small frames and readings shared by the tests."""

import zipfile
from collections import Counter

from citewise.schemas import automobiles_schema, people_schema, speeding_schema


def people(spark, *rows):
    return spark.createDataFrame(list(rows), people_schema())


def tickets(spark, *rows):
    return spark.createDataFrame(list(rows), speeding_schema())


def automobiles(spark, *rows):
    return spark.createDataFrame(
        [(owner, plate, None, None, None) for owner, plate in rows], automobiles_schema()
    )


def ticket(id="t", officer=1, time="2020-01-05 10:00:00", school=False, work=False, plate="P"):
    return (id, officer, time, school, work, plate)


def rows(frame, *columns):
    """The rows as sorted tuples."""
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def write_zip(folder, name, members):
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / name, "w", zipfile.ZIP_DEFLATED) as bundle:
        for member, content in members.items():
            bundle.writestr(member, content)
    return str(folder)


def final_plan(frame):
    """The plan after adaptive execution has run it."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def table_scans(frame):
    """Name of table -> how often running the frame reads it; reused shuffles count once."""
    frame.collect()
    found, seen = Counter(), set()

    def each(sequence):
        return (sequence.apply(i) for i in range(sequence.size()))

    def visit(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return visit(node.plan())
        if kind == "ReusedExchangeExec":
            return None
        if kind == "FileSourceScanExec":
            found[node.relation().location().rootPaths().head().getName()] += 1
        for subquery in each(node.subqueries()):
            if subquery.getClass().getSimpleName() == "SubqueryExec" and subquery.id() not in seen:
                seen.add(subquery.id())
                visit(subquery.child())
        for child in each(node.children()):
            visit(child)
        return None

    visit(frame._jdf.queryExecution().executedPlan())
    return {name.removesuffix(".parquet"): n for name, n in found.items()}
