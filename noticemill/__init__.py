"""Find procurement notices that a registry does not know yet, as Spark DataFrame jobs."""
