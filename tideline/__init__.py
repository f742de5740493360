"""Change-data-capture and table replication expressed as Spark plans."""
