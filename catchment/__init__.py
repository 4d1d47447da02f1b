"""Branch trade areas, bank data access and data upkeep as PySpark DataFrame operators."""
