"""Sensor-reading analytics on Spark: parse, clean, route, summarise and alert."""
