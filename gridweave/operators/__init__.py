"""Operators over DataFrames: ranked picks under limits, fills, neighbour joins, statistics and calibration."""
