"""Training-data operators: corpus-scale jobs over documents, pages and conversations.

Nothing else in the library imports this package. Each module holds one operator with
its own general interface; ``queries`` derives the checked ``opN_*`` results from them.
"""
