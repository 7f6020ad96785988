"""cellwatch: battery-fleet analytics as Spark DataFrame / SQL / ML plans."""
