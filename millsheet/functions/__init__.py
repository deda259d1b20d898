"""millsheet.functions"""
