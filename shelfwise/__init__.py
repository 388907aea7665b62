"""Replenishment signals from point-of-sale rows, as Spark DataFrame operators.

Every public function takes and returns DataFrames (or Columns); nothing in
the library collects rows to the driver.
"""
