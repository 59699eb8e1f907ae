"""orewright: analytics workloads expressed as Spark DataFrame operators."""
