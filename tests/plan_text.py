"""Plans as text."""


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimised_plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
