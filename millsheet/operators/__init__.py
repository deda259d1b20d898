"""millsheet.operators"""
