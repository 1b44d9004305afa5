"""Training-data pipeline operators (removable: nothing outside this subpackage imports it)."""
