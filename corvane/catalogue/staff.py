"""Questions about employees, and movies that are worth seeing."""

from pyspark.sql import functions as F

from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.plans import movies, staff

_HIRED = "hire_date > DATE '1999-01-01' AND hire_date < DATE '2000-01-01'"


@query(
    "emp_max_salary",
    "SELECT emp_no, max(salary) AS maxSalary FROM employees JOIN salaries USING (emp_no) GROUP BY emp_no",
    "employees salaries",
)
def max_salary(v: Views):
    return staff.with_max_salary(v.employees(), v.salaries()).select("emp_no", "maxSalary")


@query(
    "emp_best_paid_titles",
    """SELECT emp_no, maxSalary, title, strftime(max(to_date), '%Y-%m-%d') AS last_date
       FROM (SELECT emp_no, max(salary) AS maxSalary FROM employees JOIN salaries USING (emp_no) GROUP BY emp_no
             ORDER BY maxSalary DESC, emp_no LIMIT 10) JOIN titles USING (emp_no)
       GROUP BY emp_no, maxSalary, title""",
    "employees salaries titles",
)
def titles(v: Views):
    best = staff.titles_of_best_paid(v.employees(), v.salaries(), v.titles())
    return best.select("emp_no", "maxSalary", "title", F.col("last_date").cast("string").alias("last_date"))


@query("sql_hired_count", f"SELECT count(*) AS hired FROM employees WHERE {_HIRED}", "employees")
def hired(v: Views):
    return staff.hired_count(v.employees())


@query(
    "sql_avg_by_dept",
    f"""SELECT de.dept_no, round(avg(s.salary), 4) AS avg_salary FROM employees e, dept_emp de, salaries s
        WHERE {_HIRED} AND e.emp_no = de.emp_no AND e.emp_no = s.emp_no GROUP BY de.dept_no""",
    "employees dept_emp salaries",
)
def mean_by_department(v: Views):
    means = staff.mean_salary_by_department(v.employees(), v.dept_emp(), v.salaries())
    return means.withColumn("avg_salary", F.round("avg_salary", 4))


@query(
    "sql_best_dept",
    f"""SELECT round(avg(s.salary), 4) AS payments, d.dept_name
        FROM employees e, dept_emp de, salaries s, departments d
        WHERE {_HIRED} AND e.emp_no = de.emp_no AND e.emp_no = s.emp_no AND de.dept_no = d.dept_no
        GROUP BY d.dept_name ORDER BY avg(s.salary) DESC, d.dept_name LIMIT 1""",
    "employees dept_emp salaries departments",
)
def best_department(v: Views):
    best = staff.best_paying_department(v.employees(), v.dept_emp(), v.salaries(), v.departments())
    return best.withColumn("payments", F.round("payments", 4))


@query(
    "movies_good_comedies",
    """SELECT Title, IMDB_Rating AS Rating, Release_Date AS Release FROM movies
       WHERE Major_Genre = 'ECONOMY' AND IMDB_Rating > 6.5""",
    "movies",
)
def good_movies(v: Views):
    return movies.good_movies(v.movies(), genre="ECONOMY")
