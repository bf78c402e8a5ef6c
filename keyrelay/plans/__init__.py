"""keyrelay.plans"""
