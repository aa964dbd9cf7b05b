"""usagelake: device-usage lakehouse jobs and usage-based billing on PySpark."""
