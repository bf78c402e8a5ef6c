"""keyrelay.streaming"""
