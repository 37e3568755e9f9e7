"""Distributed DataFrame operators for web-log, claims, classification and rating analysis.

Every operator takes and returns DataFrames. Only model training and the
small metric tables it yields act on the data; everything else is lazy.
"""
