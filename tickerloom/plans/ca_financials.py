"""Canadian financials: landed statement matrices -> long statement rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickerloom.operators import statements
from tickerloom.operators.gate import semi_join_universe
from tickerloom.sources.payloads import matrix_cells, statement_cells


def ca_financials(issuers: DataFrame, matrix: DataFrame) -> DataFrame:
    """Most recent period of each issuer's statements, from the best API that returned any.

    The API is chosen by all of its cells: one whose first period is missing gives nothing, and no other
    API stands in for it. The cut to the first period is pushed below the join with the chosen API.
    """
    best = statements.first_source_cells(semi_join_universe(matrix, issuers))
    return statements.statement_rows(statement_cells(statements.most_recent_period(best)))


def ca_financials_landed(issuers: DataFrame, matrices: DataFrame) -> DataFrame:
    """:func:`ca_financials` from landed matrices (:func:`files.read_statement_matrices`).

    Other issuers' files are left out before they are taken apart.
    """
    return ca_financials(issuers, matrix_cells(semi_join_universe(matrices, issuers)))
