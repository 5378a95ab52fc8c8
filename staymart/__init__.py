"""Booking-finance analytics expressed as Spark DataFrame and SQL plans.

Layers, from the bottom up:

* ``staymart.functions``  column expressions, one row in, one value out
* ``staymart.operators``  DataFrame-to-DataFrame building blocks (lookups, as-of,
  exchange, exclusion)
* ``staymart.plans``      booking measures and the wide extract
* ``staymart.sources``    table catalogue, readers and the dated sink
"""
