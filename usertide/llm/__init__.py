"""Operators for preparing training text: one module each, independent of the rest of the library.

``usertide.llm.queries`` holds their registered queries.
"""
