"""Query catalogue.

``*_queries`` modules register one query per analysis of the three case
studies (and the tasks they state) over the analysis tables, each with the
SQL text of an independent oracle (``registry.QUERIES``; import
``catalogue`` to load them all).  ``delivery``, ``subscriptions`` and
``bank`` hold the same analyses over the case studies' own table layouts.
"""
