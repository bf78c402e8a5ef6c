"""keyrelay.operators"""
