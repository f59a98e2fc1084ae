"""Watchlist consolidation as Spark jobs.

Layers, each importing only those above it:

``fixed_values``  constants and schemas the results depend on
``functions``     column expressions
``sources``       scans and sinks
``operators``     DataFrame -> DataFrame transforms
``plans``         whole jobs built from the above
``streaming``     the same transforms over files as they land
``queries``       one registered query per operator, with its check SQL
"""
