"""Employee ranks and titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfare.operators.ranking import nth_distinct, ranks_of_values, with_rank
from wayfare.operators.slicing import By
from wayfare.sources.tables import view as as_view


def salary_rank(
    employees: DataFrame,
    department: str = "department",
    salary: str = "salary",
    kind: str = "dense_rank",
) -> DataFrame:
    """Rank by salary in the department, highest first, as column ``rank``."""
    return with_rank(employees, [department], By(salary, desc=True), kind, "rank")


def salary_rank_sql(spark: SparkSession, view: str = "employee") -> DataFrame:
    """Dense rank in SQL: the ranks of the distinct salaries are a view to join."""
    levels = ranks_of_values(spark.table(view), ["department"], By("salary", desc=True))
    return spark.sql(
        f"""
        SELECT employee_name, e.department, e.salary, rank
        FROM {view} e JOIN {as_view(levels, view + "_levels")} l
          ON e.department <=> l.department AND e.salary <=> l.salary
        """
    )


def nth_salary(
    employees: DataFrame,
    n: int = 2,
    department: str = "department",
    salary: str = "salary",
) -> DataFrame:
    """Employees who earn the n-th highest distinct salary of their department."""
    return nth_distinct(employees, [department], By(salary, desc=True), n)


def titles(
    employees: DataFrame,
    titles: DataFrame,
    key: str = "emp_no",
    last_name: str = "last_name",
    title: str = "title",
) -> DataFrame:
    """Last names and titles by employee number, ordered by last name."""
    return (
        employees.select(key, last_name)
        .join(titles.select(key, title), key)
        .select(last_name, title)
        .orderBy(last_name, title)
    )
