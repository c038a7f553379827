"""Named queries and, for each, SQL that another engine can run for comparison."""

from monthfusion.catalogue import bronze, fusion, quality

QUERIES = {**bronze.QUERIES, **fusion.QUERIES, **quality.QUERIES}
ORACLES = {**bronze.ORACLES, **fusion.ORACLES, **quality.ORACLES}
