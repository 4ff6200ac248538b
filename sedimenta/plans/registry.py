"""All registered queries of the engine and their SQL."""

from sedimenta.plans import bulk, lanes, pairs, records, texts

QUERIES: dict = pairs.QUERIES | texts.QUERIES | records.QUERIES | lanes.QUERIES | bulk.QUERIES
SQL: dict = pairs.SQL | texts.SQL | records.SQL | lanes.SQL | bulk.SQL
