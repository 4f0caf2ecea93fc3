"""Helpers and fixture texts shared by the test modules."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"


def one(spark, expr, **cols):
    """Evaluate a column expression over a one-row DataFrame of string columns."""
    names = list(cols)
    df = spark.createDataFrame([tuple(cols[n] for n in names)], ", ".join(f"{n} string" for n in names))
    return df.select(expr.alias("r")).first()["r"]


#: A press release as an attachment gives it: indented, a header block, a dateline, wrapped lines, contacts, a company block.
PRESS_RELEASE = """
        CORPORATE COMMUNICATIONS
        Media Information
        17 March 2023

        Quieter tyres for the city

        Munich. Engineers present a tyre that rolls more quietly on wet roads.
        Its tread was cut anew, over four winters,
        on a test track near the plant.

        Media Contact.
        Press Desk
        Phone: +49 987 654

        The BMW Group
        With its four brands BMW, MINI, Rolls-Royce and BMW Motorrad, the group sells cars and motorcycles.
        """
