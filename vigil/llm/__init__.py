"""Operators of a training-data pipeline, one module each; nothing else in the library imports them.

Text rules shared by the operators: a null text counts as empty, lower-casing is that of A-Z
only, and a word is a run of bytes other than blank, tab, newline, vertical tab, form feed and
carriage return.  Texts travel to Python workers as bytes, so no text can fail to decode.
"""
