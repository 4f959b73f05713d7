"""tripmart: trip-record data from landing zone to report, as Spark jobs."""
