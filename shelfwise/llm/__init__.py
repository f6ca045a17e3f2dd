"""Training-data operators: filtering, de-duplication, decontamination, token work.

Each module holds one operator with its own general interface; ``queries``
registers one thin query per operator. Nothing outside this folder imports it.
"""
