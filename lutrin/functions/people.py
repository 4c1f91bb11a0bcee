"""Level, function and audience of students and staff."""

from pyspark.sql import functions as F

from lutrin import values as V


def cycle_of(code):
    return F.substring(code, 1, 1)


def programme_of(code):
    """The programme code that follows the cycle character."""
    return F.substring(code, 2, 2147483647)


def student_level(code):
    cycle = cycle_of(code)
    level = F.lit(None).cast("string")
    for first, label in V.CYCLE_LEVELS.items():
        level = F.when(cycle == first, label).otherwise(level)
    return level


def staff_function(status):
    return (
        F.when(status == V.LECTURER_STATUS, V.LECTURER)
        .when(status == V.PROFESSOR_STATUS, V.PROFESSOR)
        .when(status.isin(*V.EMPLOYEE_STATUSES), V.EMPLOYEE)
    )


def staff_level(status):
    return F.when(status == V.LECTURER_STATUS, V.LECTURER).when(
        status == V.PROFESSOR_STATUS, V.PROFESSOR
    )


def staff_audience(status, title):
    """Whether a staff member counts in the audience; NULL for statuses without a rule."""
    professor = (
        title.startswith(V.RESEARCHER_TITLE_START)
        | title.startswith(V.TEACHER_TITLE_START)
        | (title.startswith(V.PROFESSOR_TITLE_START) & ~title.contains(V.CLINICAL_TITLE_PART))
    )
    return (
        F.when(status.isin(*V.EMPLOYEE_STATUSES), False)
        .when(status == V.LECTURER_STATUS, F.coalesce(title == V.LECTURER_TITLE, F.lit(False)))
        .when(status == V.PROFESSOR_STATUS, F.coalesce(professor, F.lit(False)))
    )
