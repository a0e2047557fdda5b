"""tickwise — ordered price-bar analytics as Spark DataFrame / SQL / ML jobs.

Every per-ticker computation is expressed over one DataFrame that carries a
``ticker`` column; ordered operators are window functions keyed by ticker and
ordered by date, grouped models are grouped aggregates.  Nothing collects a
table to the driver.
"""

__version__ = "0.1.0"
