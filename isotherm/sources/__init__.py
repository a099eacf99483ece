"""Sources and sinks: station list, station CSV files, file listing, Parquet store, test stand-ins."""
