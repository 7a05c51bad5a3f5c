"""moraine: sequence curation, probe panels, damage evidence and occurrence lists as Spark plans."""
