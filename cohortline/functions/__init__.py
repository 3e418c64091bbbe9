"""Column builders (native Spark expressions only)."""

from cohortline.functions.codes import code_column, collate, conditional_template, template
from cohortline.functions.icd import add_dot, icd_diagnosis_dot, icd_procedure_dot
from cohortline.functions.times import parse_time, spark_pattern, static_time
from cohortline.functions.values import typed_value

__all__ = [
    "add_dot", "icd_diagnosis_dot", "icd_procedure_dot", "code_column", "template",
    "conditional_template", "collate", "parse_time", "spark_pattern", "static_time", "typed_value",
]
