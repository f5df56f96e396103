from __future__ import annotations


def values(df, *columns, order=True):
    """Rows as tuples, sorted unless the order matters."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=repr) if order else found


def final_plan(df) -> str:
    """Physical plan after adaptive execution."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]
