"""Training-data operators over document tables, one module each, and the queries registered for them.

Nothing outside this package imports it. Word-level work runs in ``mapInArrow`` over blocks of whole
texts (``words``); what must meet across documents meets in DataFrame joins and aggregates.
"""
