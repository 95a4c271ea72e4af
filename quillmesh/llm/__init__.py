"""Operators for preparing large training corpora.

Nothing outside this subpackage imports it; it can be removed without
affecting the citation-graph engine.  Each problem has a module with its
operator; ``queries`` holds the registered queries and ``oracle`` their SQL.
"""
