"""Employees, salaries, titles and departments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators.joins import without_match
from corvane.operators.ordering import top_rows


def with_max_salary(employees: DataFrame, salaries: DataFrame) -> DataFrame:
    best = salaries.groupBy("emp_no").agg(F.max("salary").alias("maxSalary"))
    return employees.join(best, "emp_no")


def never_managers(employees: DataFrame, managers: DataFrame) -> DataFrame:
    return without_match(employees, managers, "emp_no", "emp_no")


def titles_of_best_paid(employees: DataFrame, salaries: DataFrame, titles: DataFrame, n: int = 10) -> DataFrame:
    """All titles ever held by the ``n`` best paid, each with its last date.

    Spark knows the limit and measures its result, so it settles by itself
    whether the keys are broadcast.
    """
    best = top_rows(with_max_salary(employees, salaries), n, F.desc("maxSalary"), F.asc("emp_no"))
    keys = best.select("emp_no")
    held = titles.join(keys, "emp_no", "left_semi")
    latest = held.groupBy("emp_no", "title").agg(F.max("to_date").alias("last_date"))
    return best.join(latest, "emp_no")


# Employees hired strictly between the two dates. The pay of an employee is
# summed before any join, so an employee with very many salary rows meets the
# other tables as a single row. The second grouping column follows from the
# first; it makes the join shuffle the sums anew, so that adaptive execution can
# split an employee with very many departments there.
_HIRED = "e.hire_date > date'1999-01-01' AND e.hire_date < date'2000-01-01'"
_PAY = "(SELECT emp_no, sum(salary) AS total, count(salary) AS n FROM {salaries} GROUP BY emp_no, xxhash64(emp_no) % 2)"


def hired_count(employees: DataFrame) -> DataFrame:
    spark = employees.sparkSession
    return spark.sql(f"SELECT count(*) AS hired FROM {{employees}} e WHERE {_HIRED}", employees=employees)


def mean_salary_by_department(employees: DataFrame, dept_emp: DataFrame, salaries: DataFrame) -> DataFrame:
    return employees.sparkSession.sql(
        f"""
        SELECT de.dept_no, try_divide(sum(p.total), sum(p.n)) AS avg_salary
        FROM {{employees}} e, {{dept_emp}} de, {_PAY} p
        WHERE {_HIRED} AND e.emp_no = de.emp_no AND e.emp_no = p.emp_no
        GROUP BY de.dept_no
        """,
        employees=employees,
        dept_emp=dept_emp,
        salaries=salaries,
    )


def best_paying_department(
    employees: DataFrame, dept_emp: DataFrame, salaries: DataFrame, departments: DataFrame
) -> DataFrame:
    return employees.sparkSession.sql(
        f"""
        SELECT try_divide(sum(p.total), sum(p.n)) AS payments, d.dept_name
        FROM {{employees}} e, {{dept_emp}} de, {_PAY} p, {{departments}} d
        WHERE {_HIRED} AND e.emp_no = de.emp_no AND e.emp_no = p.emp_no AND de.dept_no = d.dept_no
        GROUP BY d.dept_name
        ORDER BY payments DESC, d.dept_name
        LIMIT 1
        """,
        employees=employees,
        dept_emp=dept_emp,
        salaries=salaries,
        departments=departments,
    )
