"""keyrelay.functions"""
