"""isotherm: analytics of monthly weather readings as Spark DataFrame operators.

Every operator is a function from DataFrame(s) to DataFrame built from Spark
expressions, joins, aggregates and windows, so the work runs on executors.

Where to start:

* ``isotherm.sources.stations.read_stations`` / ``isotherm.sources.readings.read_readings``
  read the site list and the CSV files, one per site;
* ``isotherm.operators.clean.clean_readings`` cleans them;
* ``isotherm.operators.metrics`` / ``change`` / ``regions`` compute the results;
* ``isotherm.plans.batch.run_batch`` runs the whole job;
* ``isotherm.streaming.start_incremental_ingest`` ingests new files as they arrive.
"""

__version__ = "0.1.0"
